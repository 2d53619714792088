"""Operator 2: benchmark decontamination by SimHash of item-sized windows.

A window of a document matches an item if the weighted resemblance of their shingles of five words (sum of the least
over sum of the largest weights; a shingle weighs as often as it occurs) is 0.8 or more. The work, without a shuffle:

1. A window that shares no shingle with an item has resemblance 0. So windows are taken, at each item's own number of
   words, wherever a document has a shingle of that item; a document shorter than the item is one window.
2. Windows and items have 64-bit SimHash fingerprints. A multi-index has a bucket of items for each of 8 blocks of 8 bits and
   each value; a window probes the buckets within 2 bits of its blocks: by the pigeonhole principle these hold all items
   within radius 23. Only these are candidates. At resemblance 0.8
   the expected distance is below 10 bits, its standard error below 3.
3. Items within the radius are verified with the exact weights. Of matches of an item that overlap, the best stay.

The items are sent to all executors only in parts of at most `part_items` items and `part_bytes` bytes of text, one scan of
the documents for each part, so what is broadcast is bounded whatever the benchmark's size.

Results in special cases: null or empty texts and items match nothing; an item of 1 to 4 words is one shingle and matches
where just these words stand; repeated rows and items each match by themselves; of equally good windows the first; very long
texts and items are read whole, and a text longer than a batch is one; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels
from .kernels import U64

THRESHOLD = 0.8
SIZE = 5
RADIUS = 23
BLOCKS = 8
PART_ITEMS = 20_000
PART_BYTES = 16 << 20
SCHEMA = "row long, item long, start int, n_words int, similarity double"
BITS = np.array([bin(x).count("1") for x in range(256)], np.uint8)


def simhash(hashes: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Fingerprint of each run hashes[low:high]: of each bit whether most hashes of the run have it, as 8 bytes."""
    out = np.zeros((len(low), 8), np.uint8)
    order = np.argsort(low, kind="stable")
    for at in range(0, len(order), 1 << 14):
        some = order[at : at + (1 << 14)]
        first, last = int(low[some].min()), int(high[some].max())
        need = np.zeros(last - first + 1, np.int32)
        np.add.at(need, low[some] - first, 1)
        np.add.at(need, high[some] - first, -1)
        used = np.cumsum(need[:-1]) > 0
        place = np.concatenate([[0], np.cumsum(used)])
        bits = np.unpackbits(hashes[first:last][used].view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32)
        sums = np.zeros((len(bits) + 1, 64), np.int32)
        np.cumsum(bits, axis=0, out=sums[1:])
        ones = sums[place[high[some] - first]] - sums[place[low[some] - first]]
        out[some] = np.packbits(2 * ones > (high[some] - low[some])[:, None], axis=1)
    return out


class ItemIndex:
    def __init__(self, ids: np.ndarray, texts: pa.Array, size: int = SIZE, radius: int = RADIUS, threshold: float = THRESHOLD):
        words = kernels.Words(texts)
        self.ids, self.size, self.radius, self.threshold = ids, size, radius, threshold
        self.n_words = words.counts
        at, hashes = words.windows(size)
        own = np.searchsorted(words.bounds, at, "right") - 1
        #: Shingles of the items and the items of each.
        order = np.lexsort((own, hashes))
        found, owner = hashes[order], own[order]
        new = np.ones(len(order), bool)
        new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
        where = np.flatnonzero(new)
        self.weight = np.diff(np.append(where, len(order)))
        found, self.owner = found[new], owner[new]
        self.shingles, self.first = np.unique(found, return_index=True)
        self.first = np.append(self.first, len(found))
        #: A shingle's weight in an item, by (item, shingle).
        code = self.owner * np.int64(len(self.shingles) + 1) + np.searchsorted(self.shingles, found)
        order = np.argsort(code)
        self.code, self.code_weight = code[order], self.weight[order]
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[self.shingles >> U64(44)] = True
        long = np.flatnonzero(self.n_words >= size)
        self.long = long
        low = np.searchsorted(at, words.bounds[long])
        self.prints = np.zeros((len(ids), 8), np.uint8)
        self.prints[long] = simhash(hashes, low, low + self.n_words[long] - size + 1)
        #: Multi-index: (block, value) -> items, as one sorted list; a probe asks for the values within radius // BLOCKS bits.
        block = np.tile(np.arange(BLOCKS), len(long))
        slot = block * 256 + self.prints[long].ravel()
        order = np.argsort(slot, kind="stable")
        self.bucket = np.searchsorted(slot[order], np.arange(BLOCKS * 256 + 1))
        self.bucket_items = np.repeat(long, BLOCKS)[order]
        self.flips = np.flatnonzero(BITS <= radius // BLOCKS)
        #: Items shorter than a shingle: their number of words and hash.
        self.short = {int(n): np.flatnonzero(self.n_words == n) for n in np.unique(self.n_words) if 0 < n < size}
        self.short_hash = {n: kernels.ranged(words.hashes, words.bounds[i], words.bounds[i + 1], kernels.WORD_BASE) for n, i in self.short.items()}

    def candidates(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) of all items within the radius of each window's fingerprint, from the buckets of the multi-index.

        Windows of one value of a block ask its buckets together, and pairs are checked as they come, some at a time.
        """
        whole = np.ascontiguousarray(self.prints).view(U64).ravel()
        mine = np.ascontiguousarray(prints).view(U64).ravel()
        found = [np.zeros(0, np.int64)]
        for b in range(BLOCKS):
            order = np.argsort(prints[:, b], kind="stable")
            bounds = np.searchsorted(prints[order, b], np.arange(257))
            for value in np.flatnonzero(np.diff(bounds)).tolist():
                slots = b * 256 + (value ^ self.flips)
                items = np.concatenate([self.bucket_items[self.bucket[x] : self.bucket[x + 1]] for x in slots.tolist()])
                windows = order[bounds[value] : bounds[value + 1]]
                step = max(1, (1 << 20) // max(1, len(items)))
                for low in range(0, len(windows), step):
                    some = windows[low : low + step]
                    w, i = np.nonzero(np.bitwise_count(mine[some][:, None] ^ whole[items][None, :]) <= self.radius)
                    found.append(some[w] * np.int64(len(whole)) + items[i])
        pairs = np.unique(np.concatenate(found))
        return pairs // max(1, len(whole)), pairs % max(1, len(whole))

    def matches(self, words: kernels.Words) -> list[tuple[int, int, int, int, float]]:
        """(text, item, first word within the text, number of words, resemblance)."""
        out = [m for n in self.short for m in self._short(words, n)]
        at, hashes = words.windows(self.size)
        seen = np.flatnonzero(self.sieve[hashes >> U64(44)])
        place = np.minimum(np.searchsorted(self.shingles, hashes[seen]), max(0, len(self.shingles) - 1))
        good = self.shingles[place] == hashes[seen] if len(self.shingles) else np.zeros(len(seen), bool)
        seen, place = seen[good], place[good]
        if not len(seen):
            return out
        # Seeds: (place of a shingle, item that has it).
        many = self.first[place + 1] - self.first[place]
        seed = np.repeat(seen, many)
        item = self.owner[np.repeat(self.first[place], many) + kernels.runs(np.concatenate([[0], np.cumsum(many)]), 1) - np.repeat(np.cumsum(many) - many, many)]
        order = np.lexsort((seed, item))
        seed, item = seed[order], item[order]
        row = np.searchsorted(words.bounds, at[seed], "right") - 1
        # Starts of the windows that hold a seed, each once for an item and text.
        n = np.minimum(self.n_words[item], words.counts[row])
        low = np.maximum(at[seed] - (n - self.size), words.bounds[row])
        same = np.zeros(len(seed), bool)
        same[1:] = (item[1:] == item[:-1]) & (row[1:] == row[:-1])
        low[1:] = np.where(same[1:], np.maximum(low[1:], at[seed[:-1]] + 1), low[1:])
        high = np.minimum(at[seed], words.bounds[row + 1] - n)
        many = np.maximum(high - low + 1, 0)
        start = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        size = np.repeat(n, many)
        order = np.lexsort((size, start))
        start, size = start[order], size[order]
        new = np.ones(len(start), bool)
        new[1:] = (start[1:] != start[:-1]) | (size[1:] != size[:-1])
        start, size = start[new], size[new]
        first = np.searchsorted(at, start)
        last = first + size - self.size + 1
        window, found = self.candidates(simhash(hashes, first, last))
        # The seeds of an item in a window bound what they share.
        key = item * np.int64(len(hashes) + 1) + seed
        base = found * np.int64(len(hashes) + 1)
        bound = np.searchsorted(key, base + last[window]) - np.searchsorted(key, base + first[window])
        largest = np.maximum(last[window] - first[window], self.n_words[found] - self.size + 1)
        may = bound >= self.threshold * largest - 1e-9
        verified = []
        for w, i in zip(window[may].tolist(), found[may].tolist()):
            s = self.similarity(hashes[first[w] : last[w]], i)
            if s >= self.threshold - 1e-9:
                verified.append((int(np.searchsorted(words.bounds, start[w], "right") - 1), i, int(start[w]), int(size[w]), s))
        return out + best(verified, words.bounds)

    def similarity(self, hashes: np.ndarray, item: int) -> float:
        found, n = np.unique(hashes, return_counts=True)
        place = np.minimum(np.searchsorted(self.shingles, found), len(self.shingles) - 1)
        code = item * np.int64(len(self.shingles) + 1) + place
        at = np.minimum(np.searchsorted(self.code, code), len(self.code) - 1)
        weight = np.where((self.shingles[place] == found) & (self.code[at] == code), self.code_weight[at], 0)
        shared = int(np.minimum(n, weight).sum())
        return shared / (len(hashes) + int(self.n_words[item]) - self.size + 1 - shared)

    def _short(self, words: kernels.Words, n: int) -> list[tuple[int, int, int, int, float]]:
        at = kernels.runs(words.bounds, n)
        hashes = kernels.ranged(words.hashes, at, at + n, kernels.WORD_BASE)
        order = np.argsort(self.short_hash[n])
        known, items = self.short_hash[n][order], self.short[n][order]
        low, high = np.searchsorted(known, hashes), np.searchsorted(known, hashes, "right")
        rows = [(int(np.searchsorted(words.bounds, at[k], "right") - 1), int(i), int(at[k]), n, 1.0) for k in np.flatnonzero(high > low) for i in items[low[k] : high[k]]]
        return best(sorted(rows, key=lambda r: (r[0], r[1], r[2])), words.bounds)


def best(matches: list, bounds: np.ndarray) -> list:
    """Of matches of one item in one text that overlap, the best, of equals the first; starts become places within the text."""
    by: dict[tuple[int, int], list] = {}
    for m in matches:
        by.setdefault(m[:2], []).append(m)
    out: list = []
    for (row, item), group in by.items():
        taken: list[tuple[int, int]] = []
        for _, _, start, size, s in sorted(group, key=lambda m: (-m[4], m[2])):
            k = bisect.bisect(taken, (start, size))
            if (k == 0 or sum(taken[k - 1]) <= start) and (k == len(taken) or start + size <= taken[k][0]):
                taken.insert(k, (start, size))
                out.append((row, item, start - int(bounds[row]), size, s))
    return sorted(out, key=lambda m: m[:3])


def find(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text", item_column: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD, part_items: int = PART_ITEMS, part_bytes: int = PART_BYTES) -> DataFrame:
    """(id, item id, start_word, n_words, similarity) of each place of a document that matches a benchmark item."""
    items = benchmark.select(F.col(item_column).cast("long").alias("item"), F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    bounds = items.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("size")).first()
    parts = max(1, -(-2 * bounds.n // part_items), -(-2 * bounds.size // part_bytes)) if bounds.n > part_items or bounds.size > part_bytes else 1
    rows = docs.select(F.col(id_column).cast("long").alias("row"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    share = F.pmod(F.xxhash64("item", "text"), F.lit(parts))
    out = None
    for k in range(parts):
        part = items.where(share == k).toArrow()
        found = rows.mapInArrow(_search(docs.sparkSession.sparkContext.broadcast(part), threshold), SCHEMA)
        out = found if out is None else out.union(found)
    return out.select(F.col("row").alias(id_column), F.col("item").alias(item_column), F.col("start").alias("start_word"), "n_words", "similarity")


def _search(part, threshold: float):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = part.value
        index = ItemIndex(items["item"].to_numpy(zero_copy_only=False), kernels.utf8(items["text"]), threshold=threshold)
        known = items["item"].to_pylist()
        for batch in kernels.rebatched(batches):
            found = index.matches(kernels.Words(batch["text"]))
            if found:
                row, item, start, size, s = zip(*found)
                columns = [batch["row"].take(pa.array(row)), pa.array([known[i] for i in item], pa.int64()), pa.array(start, pa.int32()), pa.array(size, pa.int32()), pa.array(s, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "item", "start", "n_words", "similarity"])

    return search
