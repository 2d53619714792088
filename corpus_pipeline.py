"""Cleaning pipeline over `documents`: language ID, n-gram join, substring dedup, decontamination, piece encoding.

Each stage takes (spark, docs, sf_dir), works on all rows of docs and returns a DataFrame; all but the last return the
columns of docs. run() writes each stage's result to the shared folder and reads it as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirewise.llm import decontamination, kernels, languages, ngram_join, pieces, substrings
from quirewise.llm.queries import PIECE_MODEL

#: A document whose best language contains less than this share of its n-grams is in none of the languages.
LEAST_COVER = 0.2


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters and those that no learned language covers."""
    filters = languages.learn(docs.where(~languages.held_out()))
    held = docs.select(*(F.col(c).alias(f"_of_{c}") for c in docs.columns))  # names that identify() doesn't add
    kept = languages.identify(held, filters, text="_of_text").where((F.col("lang_pred") != languages.UNKNOWN) & (F.col("lang_cover") >= LEAST_COVER))
    return kept.select(*(F.col(f"_of_{c}").alias(c) for c in docs.columns))


def keyed(docs: DataFrame) -> DataFrame:
    """Adds _key, 64 bits of id and text: rows with a null or repeated id stay apart, only equal rows share one."""
    return docs.withColumn("_key", F.xxhash64("doc_id", "text"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of linked rows: that with the least id (a null id counts as the least); all others stay.

    Of equal rows (id and text) any one stays. Only keys are
    ranked and grouped; texts move once, hashed by key, and are never sorted.
    """
    rows = keyed(docs)
    linked = kernels.written(ngram_join.join(rows, "_key").where("n_links > 0").select(F.col("_key").alias("_linked"), "class_id"), "linked")
    ids = rows.select("_key", F.coalesce("doc_id", F.lit(ngram_join.LEAST_ID)).alias("_id"))
    known = linked.groupBy("_linked", "class_id").agg(F.count("*").alias("_n"))
    heads = known.join(ids, F.col("_linked") == F.col("_key")).groupBy("class_id").agg(F.min(F.struct("_id", "_key", "_n")).alias("_least"))
    heads = kernels.written(heads.select(F.col("_least._key").alias("_head"), F.col("_least._n").alias("_n")), "heads")
    # What goes from where it stands: all linked rows but heads that stand alone.
    gone = known.join(heads.where("_n = 1"), F.col("_linked") == F.col("_head"), "left_anti").select("_linked")
    kept = rows.join(gone.hint("shuffle_hash"), F.col("_key") == F.col("_linked"), "left_anti").select(*docs.columns)
    # One of the equal rows of a head that has some: first() combines in each task before rows meet.
    equal = rows.join(heads.where("_n > 1").hint("shuffle_hash"), F.col("_key") == F.col("_head"), "left_semi")
    return kept.unionByName(equal.groupBy("_key").agg(F.first(F.struct(*docs.columns)).alias("_row")).select("_row.*"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out repeated passages; a document that loses all its words goes."""
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    out = substrings.dedup_substrings(docs, keep=("doc_id", *others))
    out = out.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    shown = {"text": F.col("kept_text")}
    if "n_chars" in docs.columns:
        shown["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return out.select(*(shown.get(c, F.col(c)).alias(c) for c in docs.columns))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the rows that hold a benchmark item, and no others with their id."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = keyed(docs)
    found = kernels.written(decontamination.find(rows, benchmark, "_key").select(F.col("_key").alias("_hit")).distinct(), "contaminated")
    return rows.join(found, F.col("_key") == F.col("_hit"), "left_anti").select(*docs.columns)


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Numbers and digests of the ids and decoded text of each document that is left."""
    return pieces.encode_decode(docs.select("doc_id", "text"), PIECE_MODEL).drop("text")


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("piece_encoding", piece_encoding),
]
#: SQL has no trained language model or tokenizer; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = kernels.written(stage(spark, docs, sf_dir), name)
    return docs
