"""Operator 4: token counts by a count-only Viterbi search over a unigram vocabulary.

An Aho-Corasick automaton enumerates the vocabulary's matches that end at each character; dynamic programming carries
the best score and the number of pieces at each place, never the pieces. Ties go by the tokenizers' rule: of equal
scores the one whose last piece starts earliest stays. A character that no piece of one character covers may also be
taken as unknown, at ten less than the lowest score; it counts as its UTF-8 bytes where the vocabulary falls back to
bytes, else as one piece.

No public unigram model is at hand, so the vocabulary is that of a SentencePiece model file read as unigram: its normal
pieces with their scores. Pieces don't cross whitespace markers, so the best path of a text is that of its chunks side by
side, and each distinct chunk of a worker is counted once (bounded table, as in operator 8). Scores are summed as
float64.

Results in special cases: null and empty texts have 0 tokens; equal rows give equal results.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from . import kernels
from .pieces import CHUNK, MARK

TABLE_ROWS = 600_000
UNKNOWN_PENALTY = 10.0


class CountOnlyViterbi:
    def __init__(self, pieces: dict[str, float], byte_fallback: bool = True, unknown: float | None = None, rows: int = TABLE_ROWS):
        """unknown: score of an unknown character; ten less than the lowest if None."""
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p in pieces if len(p) == 1}
        self.unknown = min(pieces.values(), default=0.0) - UNKNOWN_PENALTY if unknown is None else unknown
        self.byte_fallback, self.rows, self.table = byte_fallback, rows, {}

    def count(self, text: str) -> tuple[int, int]:
        """Number of ids, and how many of them stand for unknown characters."""
        n = len(text)
        best, counts = [float("-inf")] * (n + 1), [0] * (n + 1)
        best[0] = 0.0
        if self.single.issuperset(text):  # each character has a piece: no unknown ones
            for at, (length, score) in self.automaton.iter(text):  # of those that end here, the longest first
                start = at + 1 - length
                if (x := best[start] + score) > best[at + 1]:  # of equals the earliest start stays
                    best[at + 1], counts[at + 1] = x, counts[start] + 1
            return counts[n], 0
        ending: list[list] = [[] for _ in range(n)]
        for at, match in self.automaton.iter(text):
            ending[at].append(match)
        lost = [0] * (n + 1)
        for at, c in enumerate(text):
            for length, score in ending[at]:
                start = at + 1 - length
                if (x := best[start] + score) > best[at + 1]:
                    best[at + 1], counts[at + 1], lost[at + 1] = x, counts[start] + 1, lost[start]
            if c not in self.single and best[at] + self.unknown > best[at + 1]:
                ids = len(c.encode("utf-8", "surrogatepass")) if self.byte_fallback else 1
                best[at + 1], counts[at + 1], lost[at + 1] = best[at] + self.unknown, counts[at] + ids, lost[at] + ids
        return counts[n], lost[n]

    def row(self, text: str) -> tuple[int, int]:
        if not text:
            return 0, 0
        parts = text.replace(" ", MARK).split(MARK)
        chunks = CHUNK.findall(MARK + text.replace(" ", MARK)) if "" in parts else [MARK + p for p in parts]
        try:
            total = sum(map(self.table.__getitem__, chunks))
        except KeyError:
            new = [c for c in set(chunks) if c not in self.table]
            if len(self.table) + len(new) > self.rows:
                self.table.clear()
                new = set(chunks)
            for c in new:
                n, lost = self.count(c)
                self.table[c] = n + (lost << 40)  # one number each keeps the table small
            total = sum(map(self.table.__getitem__, chunks))
        return total & ((1 << 40) - 1), total >> 40


def unigram_vocabulary(model: str) -> dict[str, float]:
    """Normal pieces and scores of a SentencePiece model file."""
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=model)
    return {p.id_to_piece(i): p.get_score(i) for i in range(p.get_piece_size()) if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i) or p.is_unused(i))}


@lru_cache(maxsize=2)
def counter(model: str, rows: int) -> CountOnlyViterbi:
    return CountOnlyViterbi(unigram_vocabulary(model), rows=rows)


def count_tokens(docs: DataFrame, model: str, text: str = "text", table_rows: int = TABLE_ROWS) -> DataFrame:
    """Adds n_tokens and n_unknown (ids that stand for unknown characters) of each whole text; columns of docs with these names are replaced."""
    docs = docs.drop("n_tokens", "n_unknown")
    names = docs.columns

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        viterbi = counter(model, table_rows)
        for batch in kernels.rebatched(batches, text):
            rows = [viterbi.row(t) for t in batch[text].to_pylist()]
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), (pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*names, "n_tokens", "n_unknown"])

    return docs.mapInArrow(counted, kernels.added(docs, "n_tokens long", "n_unknown long"))
