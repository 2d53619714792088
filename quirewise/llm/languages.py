"""Operator 3: language identification by language-bitmask n-gram filters.

Each language has a Bloom filter of its frequent character n-grams. The filters are bit-sliced: row p of the table holds
bit p of every language's filter, so one n-gram's few rows, ANDed, give the set of all languages that may contain it.
A text's n-grams are looked up, each language's bits are counted, each count is corrected for its filter's rate of false
positives, and the language with the largest corrected share wins.

Learning reads a sample of labelled rows bounded by `sample_per_language` (expected rows of a language, taken by a hash
of the id; whole texts), counts n-grams per language in the cluster and keeps those with a rate of `min_rate` or more,
so at most 1 / min_rate for a language and n: only these reach the driver. Scoring is one pass without a shuffle.

Results in special cases: `und` with score 0 for a null text or one without letters, and for every text if nothing could
be learned; a text none of whose n-grams is known gets the language with most sampled n-grams, at score 0; of equal
shares the first language by name; equal texts get equal results; a long text is cut into parts where it has no letter, which
changes no count, so memory is bounded by PART and the longest run of letters; columns named as those added are replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels

U64 = np.uint64
SIZES = (3, 4)
SAMPLE_PER_LANGUAGE = 1500
MIN_RATE = 2e-5
#: An n-gram belongs to a language if its rate there is this share of its highest rate at least.
MIN_SHARE = 0.05
PROBES = 3
UNKNOWN = "und"
PART = 1 << 20


#: Some of what is no letter.
NO_LETTER = re.compile(r"[\W\d_]")


def cut(text: str) -> Iterator[str]:
    """The text in parts of about PART characters, cut after what is no letter; a longer run of letters stays whole."""
    low = 0
    while len(text) - low > PART and (m := NO_LETTER.search(text, low + PART)):
        yield text[low : m.end()]
        low = m.end()
    if low < len(text):
        yield text[low:]


@lru_cache(maxsize=1)
def letter_codes() -> np.ndarray:
    """Code point -> its lower-case code point, or 32 if it is no letter."""
    out = np.full(0x110000, 32, np.uint32)
    for i in range(0x110000):
        if not 0xD800 <= i < 0xE000 and (c := chr(i)).isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


class Grams:
    """Hashes of the n-grams of texts in lower case, all that is no letter being one space, with a space at both ends."""

    def __init__(self, sizes: tuple[int, ...] = SIZES):
        self.sizes, self.codes = sizes, letter_codes()

    def of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Text and hash of each n-gram."""
        found = list(self.stretches(texts))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, U64)
        return tuple(map(np.concatenate, zip(*found)))

    def stretches(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Text and hash of each n-gram, for about PART characters at a time. A long text is cut where there is no letter:
        all but the ends of an n-gram are letters, so none is lost or counted twice there."""
        plain, owner, size = [], [], 0
        for i, text in enumerate(texts):
            for part in cut(text or ""):
                if plain and size + len(part) > PART:
                    yield self._of(plain, owner)
                    plain, owner, size = [], [], 0
                plain.append(part)
                owner.append(i)
                size += len(part)
        if plain:
            yield self._of(plain, owner)

    def _of(self, plain: list[str], owner: list[int]) -> tuple[np.ndarray, np.ndarray]:
        joined = "\x00".join(plain)
        x = self.codes[np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)]
        lengths = np.fromiter(map(len, plain), np.int64, len(plain))
        own = np.repeat(np.array(owner, np.int64), lengths + 1)[: len(x)]
        space = x == 32
        kept = np.ones(len(x), bool)
        kept[1:] = ~(space[1:] & space[:-1])
        x, own = np.concatenate([[32], x[kept], [32]]).astype(U64), np.concatenate([own[:1], own[kept], own[-1:]])
        hashes, owners = [], []
        for n in self.sizes:
            if len(x) < n:
                continue
            h = x[: len(x) - n + 1].copy()
            for j in range(1, n):
                h = h * U64(0x9E3779B97F4A7C15) + x[j : len(x) - n + 1 + j]
            inner = x[1 : len(x) - n + 2] != 32  # the second is a letter: no n-gram lies over two texts before its first word
            for j in range(2, n - 1):
                inner &= x[j : len(x) - n + 1 + j] != 32
            hashes.append(kernels.mixed(h[inner] + U64(n)))
            owners.append(own[1 : len(x) - n + 2][inner])
        if not hashes:
            return np.zeros(0, np.int64), np.zeros(0, U64)
        return np.concatenate(owners), np.concatenate(hashes)


@dataclass
class LanguageFilters:
    languages: list[str]
    table: np.ndarray  #: (rows, words of 64 languages)
    false_rate: np.ndarray  #: of each language
    fallback: int  #: place of the language with most n-grams

    def rows(self, hashes: np.ndarray) -> list[np.ndarray]:
        mask = U64(len(self.table) - 1)
        step = (hashes >> U64(32)) | U64(1)
        return [((hashes + U64(i) * step) & mask).astype(np.int64) for i in range(PROBES)]

    def masks(self, hashes: np.ndarray) -> np.ndarray:
        """Bitmask of the languages that may contain each n-gram."""
        first, *others = self.rows(hashes)
        out = self.table[first]
        for r in others:
            out &= self.table[r]
        return out

    def shares(self, grams: Iterator[tuple[np.ndarray, np.ndarray]], n: int) -> tuple[np.ndarray, np.ndarray]:
        """(texts, languages): corrected share of a text's n-grams that a language contains; n-grams of each text."""
        total, out = np.zeros(n), np.zeros((n, len(self.languages)))
        for owners, hashes in grams:
            masks = self.masks(hashes)
            total += np.bincount(owners, minlength=n)
            for k in range(len(self.languages)):
                bit = (masks[:, k // 64] >> U64(k % 64)) & U64(1)
                out[:, k] += np.bincount(owners, weights=bit, minlength=n)
        out /= np.maximum(total, 1)[:, None]
        return np.clip((out - self.false_rate) / np.maximum(1 - self.false_rate, 1e-9), 0, 1), total

    @staticmethod
    def build(rates: dict[str, tuple[np.ndarray, int]]) -> LanguageFilters:
        """rates: language -> (hashes of its n-grams, n-grams sampled)."""
        languages = sorted(rates)
        most = max((len(h) for h, _ in rates.values()), default=1)
        rows = 1 << max(10, math.ceil(math.log2(8 * max(1, most))))
        table = np.zeros((rows, max(1, -(-len(languages) // 64))), U64)
        out = LanguageFilters(languages, table, np.zeros(len(languages)), 0)
        for k, name in enumerate(languages):
            for r in out.rows(rates[name][0]):
                np.bitwise_or.at(table[:, k // 64], r, U64(1 << (k % 64)))
            out.false_rate[k] = ((table[:, k // 64] >> U64(k % 64)) & U64(1)).mean() ** PROBES
        if languages:
            out.fallback = max(range(len(languages)), key=lambda k: (rates[languages[k]][1], -k))
        return out


def learn(labelled: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang", sample_per_language: int = SAMPLE_PER_LANGUAGE, min_rate: float = MIN_RATE, min_share: float = MIN_SHARE, sizes: tuple[int, ...] = SIZES) -> LanguageFilters:
    """Filters from the rows of labelled that have a language; languages are bounded by their number, rows by the sample."""
    rows = labelled.select(F.col(id_column).alias("_id"), F.col(text).alias("_text"), F.col(lang).alias("_lang")).where(F.col("_lang").isNotNull() & F.col("_text").isNotNull())
    sizes_of = rows.groupBy("_lang").count()
    share = F.least(F.lit(1.0), F.lit(float(sample_per_language)) / F.col("count"))
    picked = F.pmod(F.xxhash64(F.col("_id").cast("string"), F.lit("language sample")), F.lit(1 << 30)) < share * (1 << 30)
    sample = rows.join(F.broadcast(sizes_of), "_lang").where(picked).select("_lang", "_text")  # a row for each language

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(sizes)
        for batch in kernels.rebatched(batches, "_text"):
            names, codes = np.unique(np.array(batch["_lang"].to_pylist()), return_inverse=True)
            own, hashes = grams.of(batch["_text"].to_pylist())
            for k, name in enumerate(names.tolist()):
                found, n = np.unique(hashes[codes[own] == k], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(found), pa.string()), kernels.signed(found), pa.array(n)], names=["lang", "gram", "n"])

    counts = sample.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = kernels.written(counts, "gram-counts")
    totals = {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}  # a row for each language
    if not totals:
        return LanguageFilters.build({})
    rate = F.col("n") / F.create_map([F.lit(x) for kv in totals.items() for x in kv])[F.col("lang")]
    rated = counts.withColumn("rate", rate).where(F.col("rate") >= min_rate)  # 1 / min_rate rows for a language and size at most
    frame = rated.select("lang", "gram", "rate").toPandas()
    highest = frame.groupby("gram")["rate"].transform("max")
    frame = frame[frame["rate"] >= min_share * highest]
    return LanguageFilters.build({name: (part["gram"].to_numpy().view(U64), totals[name]) for name, part in frame.groupby("lang")} | {x: (np.zeros(0, U64), n) for x, n in totals.items() if x not in set(frame["lang"])})


def identify(docs: DataFrame, filters: LanguageFilters, text: str = "text", sizes: tuple[int, ...] = SIZES) -> DataFrame:
    """Adds lang_pred, score (share of the winner among all languages' corrected shares) and lang_cover (the winner's
    corrected share of the text's n-grams); columns of docs with these names are replaced."""
    docs = docs.drop("lang_pred", "score", "lang_cover")
    names = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(filters)  # bounded by languages / min_rate

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, model = Grams(sizes), shared.value
        labels = np.array([*model.languages, UNKNOWN], object)
        for batch in kernels.rebatched(batches, text, most=1 << 20):
            n = len(batch)
            best, score, cover = np.full(n, len(labels) - 1), np.zeros(n), np.zeros(n)
            if model.languages:
                shares, total = model.shares(grams.stretches(batch[text].to_pylist()), n)
                top = shares.argmax(1)
                cover = shares[np.arange(n), top]
                score = np.divide(cover, shares.sum(1), out=np.zeros(n), where=cover > 0)
                best = np.where(total > 0, np.where(cover > 0, top, model.fallback), best)
            columns = [pa.array(labels[best], pa.string()), pa.array(score), pa.array(cover)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*names, "lang_pred", "score", "lang_cover"])

    return docs.mapInArrow(scored, kernels.added(docs, "lang_pred string", "score double", "lang_cover double"))


def held_out(id_column: str | Column = "doc_id", parts: int = 4, which: int = 2) -> Column:
    """Whether crc32(id as text) mod parts is which; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % parts == which, F.lit(False))
