"""Operator 5: document fingerprints as bottom-k sketches of shingle hashes, in DataFrame functions only.

A sketch is the sorted array of the k smallest distinct hashes of a text's shingles (five words; a shorter text has one
shingle, all its words). The sketch of a union is the k smallest of the sketches' union, so sketches merge across parts;
two sketches estimate resemblance, containment and the number of distinct shingles. Below k shingles all are exact.

Results in special cases: null is the empty text, whose sketch is empty; two empty sketches have resemblance 1, an empty
and another one 0; equal texts have equal sketches; columns of the input other than the two named are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 256
WORDS = 5
BLANKS = " \t\n\x0b\f\r"
LEAST_ID = -(2**63)
#: Documents of one bucket of successive ids.
BUCKET_ROWS = 1024


def let(value: Column, body) -> Column:
    """body(value), with value evaluated once."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[ \t\n\x0B\f\r]+"))


def shingles(text: Column, size: int = WORDS) -> Column:
    """Hash of each run of `size` words, in order; nulls past the end add nothing to a hash."""

    def hashed(w: Column) -> Column:
        each = F.transform(w, lambda x, i: F.xxhash64(x, *(F.get(w, i + j) for j in range(1, size))))
        return F.slice(each, F.lit(1), F.greatest(F.size(w) - (size - 1), F.least(F.size(w), F.lit(1))))

    return let(words(F.coalesce(text, F.lit(""))), hashed)


def sketch(text: Column, k: int = K, size: int = WORDS) -> Column:
    return F.slice(F.sort_array(F.array_distinct(shingles(text, size))), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of what a and b are sketches of."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimate of |A and B| / |A or B|: the share of the union's sketch that is in both."""
    both = let(merge(a, b, k), lambda u: F.struct(F.size(u).alias("n"), F.size(F.array_intersect(F.array_intersect(u, a), b)).alias("shared")))
    return let(both, lambda x: F.when(x["n"] == 0, F.lit(1.0)).otherwise(x["shared"] / F.greatest(x["n"], F.lit(1))))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimate of |A|; exact below k."""
    top = (F.element_at(a, -1).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / top)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimate of |A and B| / |A|; 1 if A is empty."""

    def of(r: Column) -> Column:
        n, m = distinct_shingles(a, k), distinct_shingles(b, k)
        return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), r * (n + m) / (1 + r) / F.greatest(n, F.lit(1.0))))

    return let(resemblance(a, b, k), of)


def text_of(a: Column) -> Column:
    """A sketch as text: 16 hex digits a hash."""
    return F.lower(F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def merge_groups(sketches: DataFrame, keys: list[str], sketch_column: str = "sketch", k: int = K) -> DataFrame:
    """One sketch for each key: hashes are made distinct and ranked in part before they meet, so a hot key sends k a task."""
    hashes = sketches.select(*keys, F.explode(sketch_column).alias("_hash")).distinct()
    least = hashes.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy("_hash"))).where(F.col("_rank") <= k)
    return least.groupBy(*keys).agg(F.sort_array(F.collect_list("_hash")).alias(sketch_column))


def buckets(docs: DataFrame, key: str, rows: int = BUCKET_ROWS) -> tuple[Column, list[tuple[int, int]]]:
    """Bucket of a key, by quantiles, and (bucket, largest key) of each that has rows. Both are bounded by the number of
    buckets, which is that of the rows over `rows`, and two arrays of its square root are searched for each row."""
    n = docs.count()
    many = max(1, min(1 << 16, math.ceil(n / rows)))
    cuts = docs.agg(F.percentile_approx(key, [i / many for i in range(1, many)], 10 * many).alias("cuts")).first().cuts if many > 1 else None
    cuts = sorted(set(cuts or []))
    step = max(1, math.isqrt(len(cuts)))
    parts = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    if not parts:
        bucket = F.lit(0)
    else:
        longs = lambda xs: F.array(*(F.lit(x).cast("long") for x in xs))
        coarse, fine = longs([p[0] for p in parts]), F.array(*(longs(p) for p in parts))
        below = lambda xs: F.size(F.filter(xs, lambda c: c < F.col(key)))
        bucket = let(below(coarse), lambda i: F.when(i == 0, F.lit(0)).otherwise((i - 1) * step + below(F.get(fine, i - 1))))
    tops = docs.groupBy(bucket.alias("bucket")).agg(F.max(key).alias("top")).collect()
    return bucket, sorted((r.bucket, r.top) for r in tops)


def with_next(docs: DataFrame, key: str, value: str, rows: int = BUCKET_ROWS) -> DataFrame:
    """Rows of docs(key, value) with _bucket and _ghost, ordered within a bucket by falling key, then value; after the
    rows of a bucket stands a ghost of what follows them: the first row of the next bucket, or of all after the last.

    One shuffle of the rows; a key's repeated rows follow each other.
    """
    bucket, tops = buckets(docs.select(key), key, rows)
    spark = docs.sparkSession
    # The largest key of a bucket also stands, as a ghost, in the bucket above; the largest of all in the lowest.
    ghosts = [(top, tops[(i + 1) % len(tops)][0]) for i, (_, top) in enumerate(tops)]
    ghosts = spark.createDataFrame(ghosts, f"_top long, _above int")
    placed = docs.withColumn("_own", bucket).join(F.broadcast(ghosts), F.col(key) == F.col("_top"), "left")  # a row a bucket
    places = F.array(F.struct(F.col("_own").alias("b"), F.lit(False).alias("g")), F.struct(F.col("_above").alias("b"), F.lit(True).alias("g")))
    placed = placed.withColumn("_place", F.explode(F.filter(places, lambda p: p["b"].isNotNull())))
    return placed.select(key, value, F.col("_place.b").alias("_bucket"), F.col("_place.g").alias("_ghost"))


def fingerprint(docs: DataFrame, id_column: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """Sketches of each text and of its edited text, and their likeness.

    The edited text has its last floor(n / 2) code points replaced by as many first ones of the next document by falling
    id (after the last the first). A null id counts as the least one; rows with equal ids follow each other by text.
    Returns id, n_chars, edited_sha256, sketch, edited_sketch, near_edited, near_next, n_shingles (estimate).
    """
    rows = docs.select(F.coalesce(F.col(id_column).cast("long"), F.lit(LEAST_ID)).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    order = Window.partitionBy("_bucket").orderBy("_ghost", F.desc("_key"), "_text")
    rows = with_next(rows, "_key", "_text").withColumn("_next", F.lead("_text").over(order))
    n = F.length("_text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("_text"), F.lit(1), n - half), F.substring(F.coalesce(F.col("_next"), F.lit("")), F.lit(1), half))
    rows = rows.select("_key", "_bucket", "_ghost", "_text", n.cast("long").alias("n_chars"), edited.alias("_edited"))
    rows = rows.select("_key", "_bucket", "_ghost", "_text", "n_chars", F.sha2("_edited", 256).alias("edited_sha256"), sketch(F.col("_text"), k).alias("sketch"), sketch(F.col("_edited"), k).alias("edited_sketch"))
    rows = rows.withColumn("_after", F.lead("sketch").over(order)).where(~F.col("_ghost"))
    return rows.select(
        F.when(F.col("_key") != LEAST_ID, F.col("_key")).alias(id_column),
        "n_chars",
        "edited_sha256",
        "sketch",
        "edited_sketch",
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("_after"), k).alias("near_next"),
        distinct_shingles(F.col("sketch"), k).alias("n_shingles"),
    )
