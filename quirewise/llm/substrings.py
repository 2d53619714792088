"""Operator 10: substring deduplication by relative Lempel-Ziv parsing against indexed reference blocks.

A window is `window` successive words of one document; a word goes if a window that covers it has the same words as a
window that starts earlier (smaller id, or same document and earlier start). The work:

1. Index. Documents come in blocks of some megabytes. A block indexes its documents by anchors: the runs of `seed` words
   with the least hash among those of a window, so equal windows have equal anchors wherever they stand, and only one
   place in seven or so is indexed. A block sends each of its anchors once; an anchor that one block has twice or two
   blocks have is repeated, and the documents that hold it learn so.
2. Factors. Only windows on repeated anchors can occur elsewhere. Each block is parsed against its own earlier text:
   windows found there are joined to maximal runs, the factors, which need no exchange. A greedy factor ends where its
   source does, and a window across the border of two factors may have a source of its own, so borders are checked by
   looking each window up for itself, not only the longest match. What has no earlier place in its block is sent, once
   a block, to meet the firsts of the other blocks by a 96-bit hash; the least place stays, the others join the factors.
3. Removal. Factors meet their documents again, which cover words and give the kept text.

A hot passage costs a row a block and distinct window, never a row a document, in steps 1 and 2, and the rows of a
document in step 3; documents move once, hashed by id (both joins use the same exchange).

Results in special cases: null and empty texts have no words; texts shorter than a window lose nothing; a null id counts
as the least one; rows with equal id and text are one place, and don't remove each other, while their repeats elsewhere
go in each of them; rows with equal id and other texts are told apart by a 64-bit hash of the text, and the same start in both
is no earlier place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernels
from .kernels import U64

WINDOW = 20
SEED = 8
LEAST_ID = -(2**63)
SECOND_BASE = 0xC2B2AE3D27D4EB4F
TOP = U64(kernels.MASK64)


def slid(x: np.ndarray, width: int, best=np.minimum) -> np.ndarray:
    """best of x[i : i + width], shorter at the end."""
    out, have = x.copy(), 1
    while have < width:
        step = min(have, width - have)
        out[:-step or None] = best(out[:-step], out[step:]) if step < len(out) else out
        have += step
    return out


class Anchors:
    """Where windows start in a block, the least seed of each, and the places that are some window's least seed."""

    def __init__(self, words: kernels.Words, window: int, seed: int):
        n = len(words.starts)
        self.span = window - seed + 1
        self.seeds = np.full(n, TOP)
        at, hashes = words.windows(seed)
        self.seeds[at] = hashes
        self.starts = kernels.runs(words.bounds, window)
        self.least = slid(self.seeds, self.span)[self.starts]
        most = np.zeros(n, U64)
        most[self.starts] = self.least
        # A place is an anchor if, of the windows that hold it, one has its seed as the least.
        self.places = np.flatnonzero((slid(most[::-1], self.span, np.maximum)[::-1] == self.seeds) & (self.seeds != TOP))

    def marked(self, places: np.ndarray) -> np.ndarray:
        """Starts of the windows one of whose least seeds is at one of these places."""
        x = np.full(len(self.seeds), TOP)
        x[places] = self.seeds[places]
        return self.starts[slid(x, self.span)[self.starts] == self.least]


def index_blocks(window: int, seed: int):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in kernels.blocks(batches):
            words = kernels.Words(block["text"])
            anchors = Anchors(words, window, seed)
            doc = block["doc"].to_numpy()[words.owners()[anchors.places]]
            found = anchors.seeds[anchors.places].view(np.int64)
            order = np.lexsort((doc, found))
            found, doc = found[order], doc[order]
            first = np.ones(len(found), bool)
            first[1:] = found[1:] != found[:-1]
            twice = np.zeros(len(found), bool)
            twice[:-1] = ~first[1:]
            twice |= ~first
            pair = first.copy()
            pair[1:] |= doc[1:] != doc[:-1]
            once, known, head = ~twice, twice & pair, twice & first
            # Places that their own block repeats need no count: they get keys that spread. One row stands for them.
            spread = kernels.mixed(found[known].view(U64) * U64(3) + kernels.mixed(doc[known].view(U64))).view(np.int64)
            key = np.concatenate([found[once], spread, found[head]])
            zeros = np.zeros(once.sum() + head.sum(), np.int64)  # the key is the anchor there
            out = [key, np.concatenate([doc[once], doc[known], doc[head]]), np.insert(zeros, once.sum(), found[known])]
            kind = np.repeat(np.array([0, 1, 2], np.int8), [once.sum(), known.sum(), head.sum()])
            table = pa.RecordBatch.from_arrays([*map(pa.array, out), pa.array(kind)], names=["key", "doc", "anchor", "kind"])
            for low in range(0, len(table), 50_000):
                yield table.slice(low, 50_000)

    return index


def factor_blocks(window: int, seed: int):
    def factor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in kernels.blocks(batches):
            block = block.sort_by("doc")
            words = kernels.Words(block["text"])
            anchors = Anchors(words, window, seed)
            own = words.owners()
            # Which places hold an anchor that is repeated: compare (row, anchor) with the rows' lists.
            lists = block["anchors"].combine_chunks()
            rows = np.repeat(np.arange(len(block)), np.diff(lists.offsets.to_numpy()))
            wanted = kernels.mixed(lists.flatten().to_numpy().view(U64) + U64(0x9E3779B97F4A7C15) * rows.astype(U64))
            have = kernels.mixed(anchors.seeds[anchors.places] + U64(0x9E3779B97F4A7C15) * own[anchors.places].astype(U64))
            starts = anchors.marked(anchors.places[np.isin(have, wanted)])
            if not len(starts):
                continue
            doc, text_hash = block["doc"].to_numpy()[own[starts]], block["text_hash"].to_numpy()[own[starts]]
            at = starts - words.bounds[own[starts]]
            one = kernels.mixed(kernels.ranged(words.hashes, starts, starts + window, kernels.PAIR_BASE))
            two = kernels.mixed(kernels.ranged(words.hashes, starts, starts + window, SECOND_BASE))
            order = np.argsort(one, kind="stable")  # equal windows by document, then start
            new = np.ones(len(order), bool)
            new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
            first = np.empty(len(order), np.int64)
            first[order] = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
            repeats = (doc > doc[first]) | ((doc == doc[first]) & (at > at[first]))
            # Factors: repeats side by side in one document.
            place = np.flatnonzero(repeats)
            edge = np.ones(len(place), bool)
            edge[1:] = (starts[place[1:]] != starts[place[:-1]] + 1) | (own[starts[place[1:]]] != own[starts[place[:-1]]])
            head = place[edge]
            length = np.diff(np.append(np.flatnonzero(edge), len(place))) + window - 1
            rest = np.flatnonzero(~repeats)
            spread = kernels.mixed(doc[head].view(U64) * U64(31) + at[head].astype(U64))
            out = [
                np.concatenate([one[rest], spread]).view(np.int64),
                np.concatenate([(two[rest] >> U64(32)).astype(np.uint32).view(np.int32), np.zeros(len(head), np.int32)]),
                np.concatenate([doc[rest], doc[head]]),
                np.concatenate([text_hash[rest], text_hash[head]]),
                np.concatenate([at[rest], at[head]]).astype(np.int32),
                np.concatenate([np.zeros(len(rest), np.int32), length.astype(np.int32)]),
            ]
            table = pa.RecordBatch.from_arrays(list(map(pa.array, out)), names=["one", "two", "doc", "text_hash", "start", "length"])
            for low in range(0, len(table), 50_000):
                yield table.slice(low, 50_000)

    return factor


def covered(words: kernels.Words, own: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Of each word whether a span covers it; spans: text, first word within it, number of words."""
    steps = np.zeros(len(words.starts) + 1, np.int64)
    low = words.bounds[own] + start
    np.add.at(steps, low, 1)
    np.add.at(steps, np.minimum(low + length, words.bounds[own + 1]), -1)
    return np.cumsum(steps[:-1]) > 0


def kept_text(words: kernels.Words, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts of kept words, joined by one space."""
    n = len(words.data)
    steps = np.zeros(n + 2, np.int8)
    starts, ends, own = words.starts[keep], words.ends[keep], words.owners()[keep]
    last = np.ones(len(own), bool)
    last[:-1] = own[1:] != own[:-1]
    steps[starts] += 1
    steps[ends + ~last] -= 1  # with the byte after it, which is the space, unless it is the last
    data = words.data.copy()
    data[ends[~last]] = 32
    inside = np.cumsum(steps[:n], dtype=np.int8).astype(bool)
    sizes = np.concatenate([[0], np.cumsum(inside)])
    return data[inside], sizes[words.offsets]


def remove_spans(keep_text: bool):
    """Adds n_words, n_removed and kept_sha256, and kept_text if asked for, to rows with text and spans."""

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in kernels.rebatched([batch]):
                words = kernels.Words(part["text"])
                spans = part["spans"]
                flat = spans.flatten()
                own = np.repeat(np.arange(len(part)), pc.list_value_length(spans).fill_null(0).to_numpy(zero_copy_only=False))
                mine = flat.field("text_hash").to_numpy() == part["text_hash"].to_numpy()[own]
                gone = covered(words, own[mine], flat.field("start").to_numpy()[mine], flat.field("length").to_numpy()[mine])
                data, offsets = kept_text(words, ~gone)
                view = memoryview(data)
                hashes = [hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                lost = np.concatenate([[0], np.cumsum(gone)])
                out = [part["doc"], pa.array(words.counts), pa.array(lost[words.bounds[1:]] - lost[words.bounds[:-1]]), pa.array(hashes, pa.string())]
                names = ["doc", "n_words", "n_removed", "kept_sha256"]
                if keep_text:
                    text = pa.LargeStringArray.from_buffers(len(part), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())
                    changed = pa.array(lost[words.bounds[1:]] > lost[words.bounds[:-1]])
                    out.append(pc.if_else(changed, text, part["text"].cast(pa.string())))
                    names.append("kept_text")
                    out += [part[c] for c in part.schema.names if c.startswith("_of_")]
                    names += [c for c in part.schema.names if c.startswith("_of_")]
                yield pa.RecordBatch.from_arrays(out, names=names)

    return remove


def repeated_spans(rows: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """(doc, spans: array of text_hash, start, length) of rows(doc, text_hash, text): the duplicate factors of each."""
    anchors = rows.select("doc", "text").mapInArrow(index_blocks(window, seed), "key long, doc long, anchor long, kind byte")
    anchors = anchors.withColumn("n", F.count("*").over(Window.partitionBy("key"))).where((F.col("kind") == 1) | ((F.col("kind") == 0) & (F.col("n") > 1)))
    lists = anchors.groupBy("doc").agg(F.collect_list(F.when(F.col("kind") == 1, F.col("anchor")).otherwise(F.col("key"))).alias("anchors")).withColumnRenamed("doc", "_doc")
    marked = rows.join(lists, F.col("doc") == F.col("_doc")).select("doc", "text_hash", "text", "anchors")
    found = marked.mapInArrow(factor_blocks(window, seed), "one long, two int, doc long, text_hash long, start int, length int")
    places = Window.partitionBy("one", "two").orderBy("doc", "start")
    found = found.withColumn("first_doc", F.first("doc").over(places)).withColumn("first_start", F.first("start").over(places))
    later = (F.col("doc") > F.col("first_doc")) | ((F.col("doc") == F.col("first_doc")) & (F.col("start") > F.col("first_start")))
    found = found.where((F.col("length") > 0) | later)
    span = F.struct("text_hash", "start", F.when(F.col("length") > 0, F.col("length")).otherwise(window).alias("length"))
    return found.groupBy("doc").agg(F.collect_list(span).alias("spans")).withColumnRenamed("doc", "_doc")


def dedup_substrings(docs: DataFrame, id_column: str = "doc_id", text: str = "text", window: int = WINDOW, seed: int = SEED, keep: tuple[str, ...] | None = None) -> DataFrame:
    """One row for each row of docs: id, n_words, n_removed, kept_sha256; with `keep`, also kept_text (the text unchanged
    where nothing goes, else the kept words joined by one space) and those columns of docs."""
    carried = [F.col(c).alias(f"_of_{c}") for c in keep or ()]
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.coalesce(F.col(id_column).cast("long"), F.lit(LEAST_ID)).alias("doc"), F.xxhash64(body).alias("text_hash"), body.alias("text"), *carried)
    spans = repeated_spans(rows.select("doc", "text_hash", "text") if carried else rows, window, seed)
    joined = rows.join(spans, F.col("doc") == F.col("_doc"), "left").drop("_doc")
    schema = "doc long, n_words long, n_removed long, kept_sha256 string"
    if keep is not None:
        schema += ", kept_text string" + "".join(f", `_of_{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    out = joined.mapInArrow(remove_spans(keep is not None), schema)
    shown = [F.when(F.col("doc") != LEAST_ID, F.col("doc")).alias(id_column), "n_words", "n_removed", "kept_sha256"]
    if keep is not None:
        shown += ["kept_text", *(F.col(f"_of_{c}").alias(c) for c in keep if c != id_column)]
    return out.select(*shown)
