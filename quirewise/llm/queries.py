"""The queries opN_<name>: each operator over its whole table with production parameters."""

from __future__ import annotations

import importlib.util
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, fingerprints, html_text, languages, licences, ngram_join, pieces, substrings, token_counts, toxicity

#: Folder of the public tokenizers' files; the package says where it is installed.
TOKENIZERS = Path(importlib.util.find_spec("public_tokenizers").origin).parent if importlib.util.find_spec("public_tokenizers") else Path("/opt/tokenizers")
PIECE_MODEL = str(TOKENIZERS / "piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = languages.held_out("doc_id", 4, 2)
    filters = languages.learn(docs.where(~held_out))
    return languages.identify(docs.select("doc_id", "text", held_out.alias("held_out")), filters).drop("text")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), PIECE_MODEL).drop("text")


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = fingerprints.fingerprint(table(spark, sf_dir, "documents").select("doc_id", "text"))
    shown = {c: fingerprints.text_of(F.col(s)) for c, s in (("fingerprint", "sketch"), ("edited_fingerprint", "edited_sketch"))}
    return prints.select("doc_id", "n_chars", "edited_sha256", *(c.alias(n) for n, c in shown.items()), "near_edited", "near_next", "n_shingles")


def op6_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return licences.scan(docs, licences.learn(docs))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = languages.held_out("doc_id", 3, 1)
    model = toxicity.learn(labels.where(~held_out).select("doc_id", "toxic"), docs.select("doc_id", "text"))
    return toxicity.score(docs.select("doc_id", "text", held_out.alias("held_out")), model).drop("text")


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_decode(table(spark, sf_dir, "documents").select("doc_id", "text"), PIECE_MODEL).drop("text")


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup_substrings(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_ngram_join, op2_decontamination, op3_language_id, op4_token_counts, op5_fingerprints, op6_licence_scan, op7_toxicity, op8_pieces, op9_main_text, op10_substring_dedup)}
WORDS_SQL = "list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
#: Where SQL can express the whole operator.
ORACLES = {
    "op1_ngram_join": f"""WITH RECURSIVE w AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS_SQL} AS ws FROM documents),
    s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE c >= 0.8 * (x.n + y.n - c) - 1e-9),
    r AS (SELECT doc_id AS node, doc_id AS other FROM w UNION SELECT r.node, l.b FROM r JOIN l ON l.a = r.other),
    k AS (SELECT l.a, count(*) AS links, count(DISTINCT y.text) FILTER (x.text <> y.text) AS texts FROM l JOIN w x ON x.doc_id = a JOIN w y ON y.doc_id = b GROUP BY 1)
    SELECT w.doc_id, c.class_id, CASE WHEN len(ws) = 0 THEN w.doc_id ELSE min(w.doc_id) OVER (PARTITION BY w.text) END AS copy_id, coalesce(k.links, 0) AS n_links, coalesce(k.texts, 0) AS n_text_links
    FROM w JOIN (SELECT node, min(other) AS class_id FROM r GROUP BY 1) c ON c.node = w.doc_id LEFT JOIN k ON k.a = w.doc_id""",
    "op10_substring_dedup": f"""WITH w AS (SELECT doc_id, {WORDS_SQL} AS ws FROM documents), f AS (SELECT doc_id, unnest(range(1, len(ws) - 18)) AS k, ws FROM w WHERE len(ws) >= 20),
    g AS (SELECT doc_id, k, array_to_string(ws[k:k + 19], ' ') AS g FROM f), d AS (SELECT doc_id, k FROM (SELECT doc_id, k, row_number() OVER (PARTITION BY g ORDER BY doc_id, k) AS n FROM g) WHERE n > 1),
    c AS (SELECT DISTINCT doc_id, unnest(range(k, k + 20)) AS k FROM d), x AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS k FROM w),
    t AS (SELECT doc_id, count(*) AS m, sha256(string_agg(word, ' ' ORDER BY k)) AS h FROM x ANTI JOIN c USING (doc_id, k) GROUP BY 1)
    SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(t.m, 0))::BIGINT AS n_removed, coalesce(t.h, sha256('')) AS kept_sha256 FROM w LEFT JOIN t USING (doc_id)""",
}
