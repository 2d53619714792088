"""Vectorised kernels over Arrow string columns, shared by the corpus operators.

Words are found and hashed on the raw UTF-8 buffer of an Arrow column, so no Python string is made per word.
A polynomial hash with an odd base modulo 2**64 is read off prefix sums; two-round mixing follows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..sources.scratch import written  # noqa: F401

U64 = np.uint64
BASE, WORD_BASE, PAIR_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F
MASK64 = (1 << 64) - 1
STRETCH = 1 << 18
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes that end a run of letters: ASCII other than a-z, A-Z.
NOT_LETTER = np.array([not (65 <= b <= 90 or 97 <= b <= 122 or b >= 128) for b in range(256)])
BYTE_CODES = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits look independent."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


@lru_cache(maxsize=16)
def _powers(base: int, log2: int) -> np.ndarray:
    out = np.full(1 << log2, base, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(base: int, n: int) -> np.ndarray:
    return _powers(base & MASK64, max(12, int(n).bit_length()))[:n]


def ranged(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int, codes: np.ndarray | None = None) -> np.ndarray:
    """Polynomial hash of values[start:end] for each pair, equal for equal runs of values wherever they stand.

    starts must not fall; stretches of about STRETCH values are taken at a time, so memory is bounded by them and the
    longest run. codes: what stands for each value.
    """
    out = np.empty(len(starts), U64)
    low = 0
    while low < len(starts):
        origin = int(starts[low])
        high = int(np.searchsorted(starts, origin + STRETCH))
        stop = int(ends[low:high].max())
        part = values[origin:stop] if codes is None else codes[values[origin:stop]]
        total = np.empty(len(part) + 1, U64)
        total[0] = 0
        np.cumsum(part * powers(base, len(part)), out=total[1:])
        inverse = powers(pow(base, -1, 1 << 64), len(part) + 1)
        first = starts[low:high] - origin
        out[low:high] = (total[ends[low:high] - origin] - total[first]) * inverse[first]
        low = high
    return out


class Words:
    """Words of the texts of one batch: byte spans, 64-bit hashes and the first word of each text."""

    def __init__(self, column: pa.Array, separators: np.ndarray = SPACE, fold: bool = False):
        column = utf8(column)
        offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
        low = int(offsets[0])
        data = column.buffers()[2]
        self.data = np.frombuffer(data, np.uint8, int(offsets[-1]) - low, low) if data is not None and offsets[-1] > low else np.zeros(0, np.uint8)
        self.offsets = offsets - low
        n = len(self.data)
        gap = np.ones(n + 1, bool)
        gap[:n] = separators[self.data]
        word = ~gap
        first, last = word.copy(), word.copy()
        first[1:] &= gap[:-1]
        last[:-1] &= gap[1:]
        edges = self.offsets[(self.offsets > 0) & (self.offsets < n)]
        first[edges] = word[edges]
        last[edges - 1] = word[edges - 1]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        codes = BYTE_CODES[LOWER] if fold else BYTE_CODES
        self.hashes = mixed(ranged(self.data, self.starts, self.ends, BASE, codes) + (self.ends - self.starts).astype(U64))
        self.bounds = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.bounds)

    def owners(self) -> np.ndarray:
        """The text that each word stands in."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def windows(self, size: int, base: int = WORD_BASE) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of each run of `size` words within one text."""
        at = runs(self.bounds, size)
        return at, mixed(ranged(self.hashes, at, at + size, base))

    def shingles(self, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
        """Text and hash of each shingle; a text of 1 to size - 1 words has one shingle, all its words."""
        at, found = self.windows(size)
        own = np.searchsorted(self.bounds, at, "right") - 1
        short = np.flatnonzero((self.counts > 0) & (self.counts < size))
        if len(short):
            extra = mixed(ranged(self.hashes, self.bounds[short], self.bounds[short + 1], WORD_BASE) + self.counts[short].astype(U64))
            own, found = np.concatenate([own, short]), np.concatenate([found, extra])
            order = np.argsort(own, kind="stable")
            own, found = own[order], found[order]
        return own, found


def runs(bounds: np.ndarray, size: int) -> np.ndarray:
    """Positions at which `size` successive words of one text start; bounds: where texts start and end."""
    counts = np.maximum(np.diff(bounds) - size + 1, 0)
    total = int(counts.sum())
    return np.arange(total) + np.repeat(bounds[:-1] - (np.cumsum(counts) - counts), counts)


def utf8(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """The column as one large_string array in which null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    return column.fill_null("") if column.null_count else column


def rebatched(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = 4 << 20, rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Batches of about `most` bytes of text at most; a longer text is a batch of its own."""
    for batch in batches:
        size = pc.binary_length(batch[text]).fill_null(0).to_numpy(zero_copy_only=False)
        total, low = np.cumsum(size, dtype=np.int64), 0
        while low < len(batch):
            high = int(np.searchsorted(total, (total[low - 1] if low else 0) + most, "right"))
            high = min(max(high, low + 1), low + rows, len(batch))
            yield batch.slice(low, high - low)
            low = high


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = 8 << 20, rows: int = 100_000) -> Iterator[pa.Table]:
    """Joins small batches into tables of about `most` bytes of text."""
    kept, size, n = [], 0, 0
    for batch in rebatched(batches, text, most, rows):
        more = batch[text].nbytes
        if kept and (size + more > most or n + len(batch) > rows):
            yield pa.Table.from_batches(kept)
            kept, size, n = [], 0, 0
        kept.append(batch)
        size, n = size + more, n + len(batch)
    if kept:
        yield pa.Table.from_batches(kept)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups, with where each starts and the last ends; rows of a group have equal non-null keys and
    follow each other in the input, which may cut them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        keys = batch[key].to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        if held and held[-1][key][-1].as_py() != keys[0]:
            cuts = np.concatenate([[0], cuts])
        if not len(cuts):
            held.append(batch)
            continue
        held.append(batch.slice(0, cuts[-1]))
        yield _bounded(pa.Table.from_batches([b for b in held if len(b)]), key)
        held = [batch.slice(cuts[-1])]
    if held:
        yield _bounded(pa.Table.from_batches(held), key)


def _bounded(table: pa.Table, key: str) -> tuple[pa.Table, np.ndarray]:
    keys = table[key].to_numpy()
    return table, np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def added(df: DataFrame, *fields: str) -> T.StructType:
    """The schema of df with further fields, each given as "name type"."""
    return T.StructType([*df.schema.fields, *(f for x in fields for f in T.StructType.fromDDL(x).fields)])
