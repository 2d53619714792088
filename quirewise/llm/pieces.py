"""Operator 8: SentencePiece encoding and decoding by a distinct-chunk table.

No piece of the vocabulary holds a marker (U+2581) after another character, so neither a merge nor a piece crosses the
place where a marker follows something else. A text is cut there, each distinct chunk of a worker's share is encoded
and decoded once by the library, and ids and decoded strings are joined back by position. The table is per Python
worker and holds at most `TABLE_ROWS` chunks; when full it is begun anew, which costs time, never results. Nothing is
shuffled, so a hot source or key has no effect, and a lost executor costs its own tasks only.

Results in special cases: null and empty texts have the end id only and decode to the empty text; a text of spaces is
encoded like any other; a U+2581 of the text counts as a space, as in the library; equal rows give equal results.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from . import kernels

TABLE_ROWS = 250_000
#: Characters of a text that are handled at once.
PART = 1 << 20
MARK = "▁"
CHUNK = re.compile(f"{MARK}+[^{MARK}]*")
SCHEMA = "n_tokens long, ids_sha256 string, decoded_sha256 string"


class ChunkTable:
    """Distinct chunk -> (number of ids, ids as text, decoded text)."""

    def __init__(self, model: str, rows: int = TABLE_ROWS):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        crossing = [p for p in map(self.library.id_to_piece, range(self.library.get_piece_size())) if re.search(f"[^{MARK}]{MARK}", p)]
        if crossing:
            raise ValueError(f"pieces cross whitespace markers: {crossing[:3]}")
        self.rows, self.table = rows, {}
        #: A chunk that has bytes among its ids is decoded behind an anchor, as a later part of a text is.
        self.anchor = self.library.encode("a")
        self.bytes = {i for i in range(self.library.get_piece_size()) if self.library.is_byte(i) or self.library.is_unknown(i)}

    def fill(self, chunks: set[str]) -> None:
        new = [c for c in chunks if c not in self.table]
        if len(self.table) + len(new) > self.rows:
            self.table.clear()
            new = list(chunks)
        if not new:
            return
        # A chunk's first marker is the one that the library puts before a text.
        found = self.library.encode([c[1:].replace(MARK, " ") for c in new], num_threads=1)
        for chunk, ids in zip(new, found):
            if not ids:  # the lone marker of no text
                ids = [self.library.piece_to_id(MARK)]
            if self.bytes.isdisjoint(ids):  # then the pieces side by side are the chunk
                text = chunk.replace(MARK, " ")
            else:
                text = self.library.decode(self.anchor + ids)[1:]
            self.table[chunk] = (len(ids), " ".join(map(str, ids)), text)

    def chunks(self, text: str) -> list[str]:
        """Of a text with its first marker."""
        parts = text.split(MARK)
        if "" not in parts[1:] and not parts[0]:
            return [MARK + p for p in parts[1:]]
        return CHUNK.findall(text)

    def parts(self, text: str) -> Iterator[str]:
        """The marked text, cut where a marker follows another character, in parts of about PART characters."""
        text = MARK + text.replace(" ", MARK)
        low = 0
        while len(text) - low > PART:
            m = re.compile(f"[^{MARK}](?={MARK})").search(text, low + PART)
            if not m:
                break
            yield text[low : m.end()]
            low = m.end()
        yield text[low:]

    def row(self, text: str, end: int) -> tuple[int, str, str]:
        ids_hash, text_hash, n, first = hashlib.sha256(), hashlib.sha256(), 1, True
        for part in self.parts(text) if text else ():
            chunks = self.chunks(part)
            table = self.table
            try:
                found = [table[c] for c in chunks]
            except KeyError:
                self.fill(set(chunks))
                found = [self.table[c] for c in chunks]
            n += sum(f[0] for f in found)
            ids_hash.update((" ".join([f[1] for f in found]) + " ").encode())
            said = "".join([f[2] for f in found])
            text_hash.update((said[1:] if first else said).encode())  # the first marker is no part of the text
            first = False
        ids_hash.update(str(end).encode())
        return n, ids_hash.hexdigest(), text_hash.hexdigest()


@lru_cache(maxsize=2)
def chunk_table(model: str, rows: int) -> ChunkTable:
    return ChunkTable(model, rows)


def encode_decode(docs: DataFrame, model: str, text: str = "text", table_rows: int = TABLE_ROWS) -> DataFrame:
    """Adds n_tokens, ids_sha256 and decoded_sha256 of each whole text; other columns stay as they are.

    model: path of a SentencePiece model that every executor can open. Columns of docs with these names are replaced.
    """
    docs = docs.drop("n_tokens", "ids_sha256", "decoded_sha256")
    names = docs.columns

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = chunk_table(model, table_rows)
        end = table.library.eos_id()
        for batch in kernels.rebatched(batches, text):
            rows = [table.row(t or "", end) for t in batch[text].to_pylist()]
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), (pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*names, "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.mapInArrow(encode, kernels.added(docs, SCHEMA))
