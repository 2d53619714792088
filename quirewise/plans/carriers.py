"""Queries that carry the operators over the given tables, and the same queries in SQL.

Geometry, titles and edits are made from the tables' own columns by integer arithmetic, the same in both languages.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as X
from ..operators import checks, corrections, layout, metadata, render, structure
from ..sources import pages as sources
from ..sources.scratch import written
from . import blocks as block_plan
from . import contents
from .run import build_package

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def longs(df: DataFrame) -> DataFrame:
    """Whole numbers as 64 bits, as the other side has them."""
    return df.select(*(F.col(c).cast("long").alias(c) if t in ("int", "smallint", "tinyint") else F.col(c) for c, t in df.dtypes))


def doc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.explode_lines(table(spark, sf_dir, "documents"), "doc_id")


LINES = "(SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1)::BIGINT AS line_no FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))"
TOKEN = r"regexp_extract({}, '^[A-Za-z]+')"


def token(c: Column) -> Column:
    return F.regexp_extract(c, "^[A-Za-z]+", 0)


def norm_sql(e: str) -> str:
    """T1 in SQL, for text that NFKC leaves alone; marks between characters need two passes as matches may not overlap."""
    e = f"regexp_replace({e}, '[{P.DASHES}]{{2,}}', '――', 'g')"
    e = f"translate({e}, '{P.PUNCTUATION_FROM}', '{P.PUNCTUATION_TO}')"
    c = P.CJK
    steps = [(f"([{c}]):", r"\1："), (f":([{c}])", r"：\1"), (f"([{c}]),", r"\1、"), (rf"([{c}])\.([{c}])", r"\1。\2"), (rf"([{c}])\.([{c}])", r"\1。\2"), (f"([{c}])[ 　]+", r"\1"), (f"[ 　]+([{c}])", r"\1"), ("[ \\t]{2,}", " "), (r"^[\s　]+|[\s　]+$", "")]
    for pattern, by in steps:
        e = f"regexp_replace({e}, '{pattern}', '{by}', 'g')"
    return e


def escape_sql(e: str) -> str:
    return f"replace(replace(replace({e}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


@query(f"SELECT doc_id, line_no, line, length(line)::BIGINT AS chars FROM {LINES}")
def lines_explode(spark, sf_dir):
    return longs(doc_lines(spark, sf_dir).withColumn("chars", F.length("line")))


@query(f"SELECT doc_id, line_no, {norm_sql('line')} AS line FROM {LINES}")
def normalize_lines(spark, sf_dir):
    return longs(doc_lines(spark, sf_dir).withColumn("line", X.normalize(F.col("line"))))


@query(
    """SELECT doc_id, list_reduce(list_prepend('', list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '')),
    lambda a, b: a || CASE WHEN regexp_matches(a, '[0-9A-Za-z]$') AND regexp_matches(b, '^[0-9A-Za-z]') THEN ' ' ELSE '' END || b) AS joined FROM documents"""
)
def join_lines(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.join_lines(F.split("text", "\n", -1)).alias("joined"))


HEADING_SQL = f"CASE doc_id % 7 WHEN 0 THEN '第' || (doc_id % 90) || '章 ' || {TOKEN.format('text')} WHEN 1 THEN 'column ' || doc_id WHEN 2 THEN doc_id || ' - ' || (doc_id % 9) || ' x' WHEN 3 THEN 'はじめに' || (doc_id % 300) WHEN 4 THEN '終章 ' || {TOKEN.format('text')} WHEN 5 THEN '解説者' ELSE string_split(text, chr(10))[1] END"


def made_heading() -> Column:
    d, t = F.col("doc_id"), token(F.col("text"))
    made = [F.concat(F.lit("第"), d % 90, F.lit("章 "), t), F.concat(F.lit("column "), d), F.concat(d, F.lit(" - "), d % 9, F.lit(" x")), F.concat(F.lit("はじめに"), d % 300), F.concat(F.lit("終章 "), t), F.lit("解説者")]
    return reduce(lambda w, k: w.when(d % 7 == k[0], k[1]), enumerate(made[1:], 1), F.when(d % 7 == 0, made[0])).otherwise(F.split("text", "\n")[0])


WORD_END_SQL = r"($|\d|[ivxlcIVXLC])"
ANY_HEAD_SQL = f"^({P.PREFIX}{P.any_of(P.FRONT_BACK)}|{P.any_of(P.UNNUMBERED_CHAPTERS)}){WORD_END_SQL}"


@query(
    f"""SELECT doc_id, CASE WHEN regexp_matches(h, '^第\\s*[{P.ROMAN_PARTS}]\\s*部') OR regexp_matches(h, '^第\\s*\\d+\\s*章') OR regexp_matches(h, '(?i)^Column\\s*\\d+')
    OR regexp_matches(h, '{ANY_HEAD_SQL}') OR regexp_matches(t, '{ANY_HEAD_SQL}') THEN '大' WHEN regexp_matches(h, '^\\d+\\s*[-‐−–—－]\\s*\\d+') THEN '中' ELSE '小' END AS level
    FROM (SELECT doc_id, {norm_sql('x')} AS h, {norm_sql("regexp_split_to_array(x, '[ \\t　]')[1]")} AS t FROM (SELECT doc_id, regexp_replace({HEADING_SQL}, '^\\s+|\\s+$', '', 'g') AS x FROM documents))"""
)
def heading_classify(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.heading_level(made_heading()).alias("level"))


RUBY_SQL = "'｜' || source || '《' || lang || '》 漢字《' || lang || '》<b>' || text || '｜'"


def made_ruby() -> Column:
    return F.concat(F.lit("｜"), "source", F.lit("《"), "lang", F.lit("》 漢字《"), "lang", F.lit("》<b>"), "text", F.lit("｜"))


STRIPPED_SQL = f"replace(regexp_replace(regexp_replace({RUBY_SQL}, '{P.RUBY_PIPE}', '\\1', 'g'), '{P.RUBY_BARE}', '\\1', 'g'), '｜', '')"


@query(f"SELECT doc_id, {STRIPPED_SQL} AS stripped, {escape_sql(STRIPPED_SQL)} AS plain, replace({escape_sql(STRIPPED_SQL)}, '\"', '&quot;') AS attribute FROM documents")
def ruby_strip(spark, sf_dir):
    s = made_ruby()
    return table(spark, sf_dir, "documents").select("doc_id", X.strip_ruby(s).alias("stripped"), X.render_plain(s).alias("plain"), X.escape_attr(X.strip_ruby(s)).alias("attribute"))


RUBY_HTML = "<ruby>\\1<rp>（</rp><rt>\\2</rt><rp>）</rp></ruby>"


@query(f"SELECT doc_id, regexp_replace(regexp_replace({escape_sql(RUBY_SQL)}, '{P.RUBY_PIPE}', '{RUBY_HTML}', 'g'), '{P.RUBY_BARE}', '{RUBY_HTML}', 'g') AS html FROM documents")
def render_inline(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.render_inline(made_ruby(), vertical=False).alias("html"))


@query()
def upright(spark, sf_dir):
    """Lookaround has no SQL; tests hold goldens."""
    return table(spark, sf_dir, "events").select("event_id", X.upright(F.concat(F.lit("第"), F.col("event_id"), F.lit("回 "), F.upper("event_type"), F.lit("!? <b id=\"12\">"), F.coalesce("props", F.lit("")))).alias("html"))


@query("SELECT page_id, (page_id % 399 + 1)::BIGINT AS value FROM pages")
def roman_pages(spark, sf_dir):
    n = F.col("page_id") % 399 + 1
    place = lambda d, i, v, x: F.array(F.lit(""), *(F.lit(s) for s in (i, i * 2, i * 3, i + v, v, v + i, v + i * 2, v + i * 3, i + x)))[d.cast("int")]
    roman = F.concat(F.repeat(F.lit("c"), (n / 100).cast("int")), place(F.floor(n / 10) % 10, "x", "l", "c"), place(n % 10, "i", "v", "x"))
    return longs(table(spark, sf_dir, "pages").select("page_id", X.roman_to_int(roman).alias("value")))


@query("SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 3 WHEN 1 THEN 2 WHEN 2 THEN 2 WHEN 3 THEN 4 WHEN 4 THEN 3 END::BIGINT AS value, doc_id % 6 NOT IN (3, 5) AS sure FROM documents")
def roman_value(spark, sf_dir):
    d = F.col("doc_id") % 6
    made = F.when(d == 0, "川").when(d == 1, "l i").when(d == 2, "11").when(d == 3, "4").when(d == 4, "Ⅲ").otherwise("六")
    return longs(table(spark, sf_dir, "documents").select("doc_id", X.roman_value(made).alias("r")).select("doc_id", "r.value", "r.sure"))


D13 = "((10 - list_sum(list_transform(range(1, 13), lambda i: CAST(substr({0}, i, 1) AS INT) * CASE WHEN i % 2 = 0 THEN 3 ELSE 1 END)) % 10) % 10)::INT"
D10 = "((11 - list_sum(list_transform(range(1, 10), lambda i: CAST(substr({0}, i, 1) AS INT) * (11 - i))) % 11) % 11)::INT"


@query(
    f"""WITH r AS (SELECT p_partkey, lpad((p_partkey * 7919 % 1000000000)::VARCHAR, 9, '0') AS b, p_partkey % 3 AS k FROM part),
    c AS (SELECT *, {D10.format('b')} AS d10, {D13.format("('978' || b)")} AS d13 FROM r)
    SELECT p_partkey, CASE WHEN k = 2 THEN NULL ELSE '978' || b || d13 END AS isbn FROM c"""
)
def isbn13(spark, sf_dir):
    body = F.lpad((F.col("p_partkey") * 7919 % 1000000000).cast("string"), 9, "0")
    thirteen = F.concat(F.lit("978-"), body, metadata.check_digit_13(F.concat(F.lit("978"), body)))
    ten = F.concat(F.lit("ISBN "), body, F.lit("-"), metadata.check_digit_10(body))
    wrong = F.concat(body, F.lit("-"), F.when(metadata.check_digit_10(body) == "X", "1").otherwise("X"))
    k = F.col("p_partkey") % 3
    raw = F.when(k == 0, thirteen).when(k == 1, ten).otherwise(wrong)
    return table(spark, sf_dir, "part").select("p_partkey", metadata.normalize_isbn(raw).alias("isbn"))


AUTHOR_END = r"(?:[,、]?[\s　]*\d{3,4}[\s　]*[-–—~〜][\s　]*\d{0,4}[\s　]*|[\s　]*(?:" + "|".join(metadata.ROLES) + r")[\s　]*)+$"


@query(
    f"""SELECT c_custkey, CASE WHEN regexp_matches(s, '{metadata.JAPANESE}') THEN regexp_replace(s, '[\\s　]*[,、][\\s　]*', '', 'g') ELSE regexp_replace(s, '\\s*,\\s*', ' ', 'g') END AS author
    FROM (SELECT c_custkey, regexp_replace(regexp_replace(CASE c_custkey % 3 WHEN 0 THEN c_name || ', Jr, 19' || lpad((c_custkey % 100)::VARCHAR, 2, '0') || '-' WHEN 1 THEN '山田, ' || c_name || ' 編著' ELSE ' ' || c_name || ' 1900-1980 訳 ' END, '{AUTHOR_END}', ''), '^\\s+|\\s+$', '', 'g') AS s FROM customer)"""
)
def author_clean(spark, sf_dir):
    k, n = F.col("c_custkey"), F.col("c_name")
    raw = F.when(k % 3 == 0, F.concat(n, F.lit(", Jr, 19"), F.lpad((k % 100).cast("string"), 2, "0"), F.lit("-"))).when(k % 3 == 1, F.concat(F.lit("山田, "), n, F.lit(" 編著"))).otherwise(F.concat(F.lit(" "), n, F.lit(" 1900-1980 訳 ")))
    return table(spark, sf_dir, "customer").select("c_custkey", metadata.clean_author(raw).alias("author"))


@query("SELECT o_orderkey, CASE o_orderkey % 3 WHEN 2 THEN strftime(o_orderdate, '%Y') ELSE strftime(o_orderdate, '%Y') || '.' || month(o_orderdate) END AS published FROM orders")
def pubdate_format(spark, sf_dir):
    k, d = F.col("o_orderkey") % 3, F.col("o_orderdate")
    raw = F.when(k == 0, F.date_format(d, "yyyyMM")).when(k == 1, F.date_format(d, "yyyy-MM")).otherwise(F.date_format(d, " yyyy "))
    return table(spark, sf_dir, "orders").select("o_orderkey", metadata.format_pubdate(raw).alias("published"))


@query("SELECT s AS spec, page_id FROM (VALUES ('1,10-13', [1,10,11,12,13]), (' 3 - 5,4', [3,4,5]), ('', []), ('9-7,2', [2])) v(s, p), pages WHERE list_contains(p, page_id)")
def page_spec(spark, sf_dir):
    specs = spark.createDataFrame([("1,10-13",), (" 3 - 5,4",), ("",), ("9-7,2",)], "spec string")
    pages = specs.select("spec", F.explode(X.page_set(F.col("spec"))).alias("p")).select("spec", F.col("p").cast("long").alias("page_id"))
    return pages.join(table(spark, sf_dir, "pages").select("page_id"), "page_id").select("spec", "page_id")


@query("SELECT s AS spec, CASE WHEN s = '1-4' THEN 'nothing removed from contents pages p3-p4' END AS warning FROM (VALUES ('1-4'), ('1,2'), ('5')) v(s)")
def contents_warning(spark, sf_dir):
    specs = spark.createDataFrame([("1-4", 0), ("1,2", 0), ("5", 2)], "spec string, removed int")
    return specs.select("spec", block_plan.contents_warning(F.col("spec"), F.lit("1-2"), F.col("removed")).alias("warning"))


# Lines with geometry: half of the documents in two columns.
GEOMETRY = f"(SELECT doc_id, line_no, line, length(line) AS n, CASE WHEN doc_id % 2 = 0 AND line_no % 2 = 0 THEN 520 ELSE 40 END AS x0, CASE WHEN doc_id % 2 = 0 AND line_no % 2 = 0 THEN 520 ELSE 40 END + CASE WHEN doc_id % 2 = 0 THEN 200 + length(line) % 240 ELSE 500 + length(line) % 300 END AS x1, (line_no // 2) * 40 AS y0 FROM {LINES} WHERE doc_id % 2 = 1 OR line_no > 0)"


def geometry(spark, sf_dir) -> DataFrame:
    l = doc_lines(spark, sf_dir)
    two, n = F.col("doc_id") % 2 == 0, F.length("line")
    x0 = F.when(two & (F.col("line_no") % 2 == 0), 520).otherwise(40)
    x1 = x0 + F.when(two, 200 + n % 240).otherwise(500 + n % 300)
    y0 = F.floor(F.col("line_no") / 2) * 40
    return l.select(F.lit("d").alias("book_id"), F.col("doc_id").alias("page"), (F.col("line_no") - 1).alias("ord"), "line", x0.cast("double").alias("x0"), x1.cast("double").alias("x1"), y0.cast("double").alias("y0"), (y0 + 30.0).alias("y1"), F.lit(30.0).alias("h"), (x1 - x0).cast("double").alias("w"), F.lit(False).alias("vertical"))


GUTTERS = f"""WITH g AS {GEOMETRY}, d AS (SELECT doc_id, count(*) AS lines FROM g GROUP BY 1),
    c AS (SELECT d.doc_id, x.x, any_value(d.lines) AS lines, count(g.line_no) AS over FROM d CROSS JOIN (SELECT unnest(range(350, 650)) AS x) x LEFT JOIN g ON g.doc_id = d.doc_id AND greatest(350, g.x0) <= x.x AND x.x < least(650, g.x1) GROUP BY 1, 2),
    f AS (SELECT doc_id, x, lines, x - row_number() OVER (PARTITION BY doc_id ORDER BY x) AS island FROM c WHERE over <= greatest(1, floor(lines * 0.05))),
    i AS (SELECT doc_id, lines, min(x) AS s, count(*) AS w FROM f GROUP BY doc_id, lines, island),
    b AS (SELECT doc_id, lines, s + w / 2.0 AS split FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY w DESC, s) AS k FROM i) WHERE k = 1 AND w >= 20),
    n AS (SELECT b.doc_id, b.lines, b.split, count(*) FILTER (g.x0 < b.split) AS first FROM b JOIN g USING (doc_id) GROUP BY ALL)"""


@query(
    f"""{GUTTERS}
    SELECT doc_id AS page, split::DOUBLE AS split FROM n WHERE least(first, lines - first) >= lines * 0.2"""
)
def gutter(spark, sf_dir):
    l = geometry(spark, sf_dir).withColumn("k0", F.col("x0")).withColumn("k1", F.col("x1")).withColumn("extent", F.lit(1000.0))
    return layout.find_gutter(l).select("page", "split")


@query(
    f"""{GUTTERS},
    q AS (SELECT g.*, {TOKEN.format("line")} AS t, coalesce(x0 >= split, false) AS col FROM g LEFT JOIN (SELECT doc_id, split FROM n WHERE least(first, lines - first) >= lines * 0.2) USING (doc_id)),
    o AS (SELECT *, lag(y0) OVER w + 30 - 30 * 0.4 AS edge, row_number() OVER w AS r FROM q WINDOW w AS (PARTITION BY doc_id, col ORDER BY y0, x0, line_no)),
    s AS (SELECT *, sum(CASE WHEN y0 < edge THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, col ORDER BY r) AS grp FROM o),
    x AS (SELECT doc_id, col, grp, string_agg(t, ' ' ORDER BY x0, r) AS txt FROM s GROUP BY 1, 2, 3), y AS (SELECT doc_id, col, grp, regexp_replace(regexp_replace(txt, ' {{2,}}', ' ', 'g'), '^\\s+|\\s+$', '', 'g') AS txt FROM x)
    SELECT doc_id AS page, row_number() OVER (PARTITION BY doc_id ORDER BY col, grp) - 1 AS "row", txt AS row_text FROM y WHERE txt <> ''"""
)
def row_cluster(spark, sf_dir):
    l = geometry(spark, sf_dir).withColumn("text", token(F.col("line"))).drop("line")
    sizes = l.select("book_id", "page").distinct().withColumn("width", F.lit(1000)).withColumn("height", F.lit(2000))
    return longs(layout.rows_of(l, sizes).select("page", "row", "row_text"))


BOXES = [(0.0, 0.0, 300.0, 200.0), (200.0, 100.0, 900.0, 600.0), (0.0, 0.0, 2000.0, 400.0)]


@query(
    f"""WITH g AS (SELECT *, (x0 + x1) / 2.0 AS cx, y0 + 15.0 AS cy FROM {GEOMETRY}), p AS (SELECT doc_id, line_no, min(el) AS el FROM g, (VALUES (0, 0, 0, 300, 200), (1, 200, 100, 900, 600), (2, 0, 0, 2000, 400)) b(el, a, b, c, d)
    WHERE cx BETWEEN a - 2 AND c + 2 AND cy BETWEEN b - 2 AND d + 2 GROUP BY 1, 2) SELECT doc_id AS page, line_no - 1 AS ord, el::BIGINT AS el FROM p"""
)
def line_to_box_first(spark, sf_dir):
    l = geometry(spark, sf_dir)
    box = F.array(*(F.struct(F.lit(k).alias("el"), F.array(*map(F.lit, b)).alias("box")) for k, b in enumerate(BOXES)))
    boxes = l.select("book_id", "page").distinct().withColumn("b", F.explode(box)).select("book_id", "page", "b.el", "b.box")
    return longs(layout.take_lines(l, boxes).select("page", "ord", "el"))


RUBY_LINES = f"(SELECT doc_id, line_no - 1 AS ord, length(line) % 5 = 0 AND line_no > 1 AS small, (line_no * 40) AS y, length(line) * 3 % 200 AS a FROM {LINES})"


@query(
    f"""WITH l AS (SELECT *, CASE WHEN small THEN 10 ELSE 30 END AS h, a AS x0, a + CASE WHEN small THEN 60 ELSE 400 END AS x1, CASE WHEN small THEN y + 28 ELSE y END AS y0 FROM {RUBY_LINES}),
    m AS (SELECT *, y0 + h AS y1, median(h) OVER (PARTITION BY doc_id) AS med, count(*) OVER (PARTITION BY doc_id) AS n FROM l),
    p AS (SELECT r.doc_id, r.ord, b.ord AS base, r.x0, r.x1, r.med, row_number() OVER (PARTITION BY r.doc_id, r.ord ORDER BY b.y0, b.ord) AS k FROM m r JOIN m b ON r.doc_id = b.doc_id AND r.n >= 3 AND r.h < r.med * 0.72 AND b.h >= b.med * 0.72
      AND b.y0 - r.y1 BETWEEN -0.4 * r.med AND 0.9 * r.med AND least(r.x1, b.x1) - greatest(r.x0, b.x0) >= (r.x1 - r.x0) * 0.5),
    f AS (SELECT *, max(x1) OVER (PARTITION BY doc_id, base ORDER BY x0, x1, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM p WHERE k = 1),
    g AS (SELECT *, sum(CASE WHEN x0 - reach <= med * 0.8 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, base ORDER BY x0, x1, ord ROWS UNBOUNDED PRECEDING) AS run FROM f)
    SELECT doc_id AS page, base, min(x0)::DOUBLE AS r0, max(x1)::DOUBLE AS r1, repeat('かな', count(*)::INT) AS ruby FROM g GROUP BY doc_id, base, run"""
)
def ruby_nearest(spark, sf_dir):
    l = doc_lines(spark, sf_dir).withColumn("small", (F.length("line") % 5 == 0) & (F.col("line_no") > 1))
    h, x0 = F.when(F.col("small"), 10.0).otherwise(30.0), (F.length("line") * 3 % 200).cast("double")
    y0 = F.col("line_no") * 40.0 + F.when(F.col("small"), 28.0).otherwise(0.0)
    l = l.select(F.lit("d").alias("book_id"), F.col("doc_id").alias("page"), (F.col("line_no") - 1).alias("ord"), F.when(F.col("small"), "か な").otherwise("本文").alias("text"), x0.alias("x0"), (x0 + F.when(F.col("small"), 60.0).otherwise(400.0)).alias("x1"), y0.alias("y0"), (y0 + h).alias("y1"), h.alias("h"), F.lit(400.0).alias("w"), F.lit(False).alias("vertical"))
    return longs(layout.ruby_runs(l).select("page", "base", "r0", "r1", "ruby"))


@query(
    f"""WITH e AS (SELECT doc_id, line_no, CASE WHEN line_no % 7 = 0 THEN 'heading' ELSE 'para' END AS kind, regexp_matches(line, '^[a-z]') AS c FROM {LINES}),
    n AS (SELECT *, CASE WHEN kind = 'para' AND c AND coalesce(lag(kind) OVER (PARTITION BY doc_id ORDER BY line_no) = 'para', false) THEN 0 ELSE 1 END AS new FROM e),
    b AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY line_no) AS seq FROM n)
    SELECT doc_id AS book_id, seq::BIGINT AS seq, any_value(kind) AS kind, min(line_no) AS page, count(*) AS n_lines FROM b GROUP BY 1, 2"""
)
def para_continue(spark, sf_dir):
    e = doc_lines(spark, sf_dir)
    e = e.select(F.col("doc_id").alias("book_id"), F.col("line_no").alias("page"), "line")
    none = [F.lit(None).cast(t or "array<int>").alias(c) for c, t in block_plan.EVENT.items() if c not in ("kind", "lines", "continues")]
    kind = F.when(F.col("page") % 7 == 0, "heading").otherwise("para")
    events = e.select("book_id", "page", F.lit(0).alias("a"), F.lit(0).alias("b"), kind.alias("kind"), F.array("line").alias("lines"), F.col("line").rlike("^[a-z]").alias("continues"), *none)
    b = block_plan.gather(events)
    return longs(b.select("book_id", "seq", "kind", "page", F.size("lines").alias("n_lines")))


@query(
    f"""WITH e AS (SELECT source AS book_id, doc_id AS page, {TOKEN.format('text')} AS title, doc_id % 3 = 0 AS header FROM documents)
    SELECT book_id, page, title FROM (SELECT *, row_number() OVER (PARTITION BY book_id, title ORDER BY page, header) AS k FROM e WHERE title <> '') WHERE k = 1 AND header"""
)
def header_promote_once(spark, sf_dir):
    e = table(spark, sf_dir, "documents").select(F.col("source").alias("book_id"), F.col("doc_id").alias("page"), F.lit(0).alias("a"), token(F.col("text")).alias("title")).where("title <> ''")
    return block_plan.promoted_headers(e.where("page % 3 <> 0"), e.where("page % 3 = 0")).select("book_id", "page", "title")


TOC = "(SELECT source AS book_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS ord, doc_id, (sum(1 + n_chars // 1000) OVER (PARTITION BY source ORDER BY doc_id))::BIGINT AS page_num FROM documents)"
N_PAGES = "(SELECT source AS book_id, (sum(n_chars) // 1100 + 1)::BIGINT AS n_pages FROM documents GROUP BY 1)"
PLAN = f"(SELECT book_id, ord, s, least(coalesce(nx + 2, n_pages), n_pages) AS e, n_pages FROM (SELECT t.*, p.n_pages, page_num + 3 AS s, lead(page_num) OVER (PARTITION BY book_id ORDER BY ord) AS nx FROM {TOC} t JOIN {N_PAGES} p USING (book_id)))"


def _toc(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    docs = table(spark, sf_dir, "documents")
    w = Window.partitionBy("source").orderBy("doc_id")
    toc = docs.select(F.col("source").alias("book_id"), F.row_number().over(w).alias("ord"), F.lit("大").alias("level"), F.concat(F.lit("t"), "doc_id").alias("title"), F.sum(1 + F.floor(F.col("n_chars") / 1000)).over(w).alias("page_num"), F.lit(False).alias("is_roman"))
    n = docs.groupBy(F.col("source").alias("book_id")).agg((F.floor(F.sum("n_chars") / 1100) + 1).cast("int").alias("n_pages"))
    return toc, n.select("book_id", F.lit(3).alias("offset")), n


@query(f"SELECT book_id, ord, s AS start, e AS \"end\" FROM {PLAN} WHERE s BETWEEN 1 AND n_pages AND s <= e")
def chapter_plan(spark, sf_dir):
    return longs(contents.chapter_plan(*_toc(spark, sf_dir))[0].select("book_id", "ord", "start", "end"))


@query(f"SELECT book_id, ord, 'range' AS reason FROM {PLAN} WHERE NOT (s BETWEEN 1 AND n_pages AND s <= e)")
def chapter_plan_rejects(spark, sf_dir):
    return longs(contents.chapter_plan(*_toc(spark, sf_dir))[1].select("book_id", "ord", "reason"))


FALLING = "(SELECT doc_id // 6 AS book_id, doc_id AS ord, doc_id % 6 * 9 + 1 + length(text) % 23 AS page_num FROM documents WHERE text IS NOT NULL)"


@query(
    f"""WITH e AS (SELECT *, lag(page_num) OVER (PARTITION BY book_id ORDER BY ord) AS p, lead(page_num) OVER (PARTITION BY book_id ORDER BY ord) AS nx FROM {FALLING}), r AS (SELECT *, coalesce(page_num <= p, false) AS falls, bool_or(coalesce(page_num <= p, false)) OVER (PARTITION BY book_id) AS refused, least(coalesce(nx - 1, 60), 60) AS en FROM e)
    SELECT book_id::VARCHAR AS book_id, ord, CASE WHEN falls THEN 'order' WHEN page_num <= 60 AND page_num <= en THEN '' ELSE 'range' END AS reason FROM r WHERE falls OR NOT refused"""
)
def chapter_plan_refused(spark, sf_dir):
    """Books of six entries, of which some have page numbers that don't rise: these have no plan."""
    docs = table(spark, sf_dir, "documents").where("text is not null")
    book = F.floor(F.col("doc_id") / 6).cast("string").alias("book_id")
    number = (F.col("doc_id") % 6 * 9 + 1 + F.length("text") % 23).cast("int").alias("page_num")
    toc = docs.select(book, F.col("doc_id").alias("ord"), F.lit("大").alias("level"), F.lit("t").alias("title"), number, F.lit(False).alias("is_roman"))
    books = toc.select("book_id").distinct()
    plan, rejects = contents.chapter_plan(toc, books.withColumn("offset", F.lit(0)), books.withColumn("n_pages", F.lit(60)))
    return longs(plan.select("book_id", "ord", F.lit("").alias("reason")).unionByName(rejects.select("book_id", "ord", "reason")))


UNCOVERED = f"(SELECT n.book_id, p AS page FROM (SELECT book_id, unnest(range(1, n_pages + 1)) AS p FROM {N_PAGES}) n WHERE p <> 2 AND NOT EXISTS (SELECT 1 FROM {PLAN} c WHERE c.book_id = n.book_id AND c.s BETWEEN 1 AND n_pages AND c.s <= c.e AND p BETWEEN c.s AND c.e))"


def _uncovered(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    toc, off, n = _toc(spark, sf_dir)
    plan = contents.chapter_plan(toc, off, n)[0]
    return plan, contents.uncovered_pages(plan, n, n.select("book_id", F.lit(2).alias("page")))


@query(f"SELECT book_id, page FROM {UNCOVERED}")
def uncovered_pages(spark, sf_dir):
    return longs(_uncovered(spark, sf_dir)[1])


@query(
    f"""WITH g AS (SELECT book_id, min(s) AS f FROM {PLAN} WHERE s BETWEEN 1 AND n_pages AND s <= e GROUP BY 1)
    SELECT u.book_id, min(u.page) AS start, coalesce(any_value(g.f) - 1, max(u.page)) AS "end" FROM {UNCOVERED} u LEFT JOIN g USING (book_id) WHERE g.f IS NULL OR u.page < g.f GROUP BY 1"""
)
def front_cover(spark, sf_dir):
    return longs(contents.cover_front(*_uncovered(spark, sf_dir)).where(F.col("title") == contents.FRONT_MATTER).select("book_id", "start", "end"))


@query(
    f"""WITH p AS (SELECT source AS book_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS page, {norm_sql('text')} AS txt FROM documents), t AS (SELECT book_id, regexp_extract(txt, '^[a-zA-Z]+') AS needle FROM p WHERE page = 7)
    SELECT t.book_id, CASE WHEN length(needle) >= 2 THEN needle END AS needle, CASE WHEN length(needle) >= 2 THEN min(p.page) - 2 END AS "offset" FROM t LEFT JOIN p ON p.book_id = t.book_id AND p.page >= 2 AND p.page <> 3 AND p.page < 62 AND contains(p.txt, t.needle) GROUP BY t.book_id, needle"""
)
def offset_probe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    pages = docs.select(F.col("source").alias("book_id"), F.row_number().over(Window.partitionBy("source").orderBy("doc_id")).alias("page"), X.normalize(F.col("text")).alias("text"))
    toc = pages.where("page = 7").select("book_id", F.lit(1).alias("ord"), F.lit("大").alias("level"), F.concat(F.lit("第2章 "), F.regexp_extract("text", "^[a-zA-Z]+", 0), F.lit("――x 12")).alias("title"), F.lit(2).alias("page_num"), F.lit(False).alias("is_roman"))
    n = pages.groupBy("book_id").agg(F.max("page").alias("n_pages"))
    return longs(contents.offset(toc, pages, n.select("book_id", F.lit(3).alias("page")), n).select("book_id", "needle", "offset"))


ROW_SQL = HEADING_SQL.replace("string_split(text, chr(10))[1]", "'第Ⅱ部 ' || source || ' xiv'")
ENTRY_SQL = rf"^(第\s*[0-9０-９IVXⅠ-Ⅴ]{{1,4}}\s*部|第\s*[0-9０-９]{{1,3}}\s*章|(?i:Column\s*\d+)|{P.any_of(P.UNNUMBERED_CHAPTERS)}($|[^・·])|{P.PREFIX}{P.any_of([w for w in P.FRONT_BACK if w not in P.CONTENTS])}{WORD_END_SQL})"


@query(
    f"""WITH r AS (SELECT doc_id, regexp_replace({ROW_SQL}, '^\\s+|\\s+$', '', 'g') AS r FROM documents), e AS (SELECT doc_id, r, regexp_extract(r, '(\\d+)\\s*$', 1) AS d, regexp_extract(r, '([ivxlcIVXLC]{{1,6}})\\s*$', 1) AS m FROM r WHERE regexp_matches(r, '{ENTRY_SQL}'))
    SELECT doc_id, CASE WHEN regexp_matches(r, '^第\\s*[0-9０-９IVXⅠ-Ⅴ]{{1,4}}\\s*部') THEN '部' ELSE '大' END AS level, d = '' AND m <> '' AS is_roman, CASE WHEN d <> '' THEN d::BIGINT WHEN m = 'xiv' THEN 14 END AS page_num,
    regexp_replace(CASE WHEN d <> '' THEN regexp_replace(r, '\\d+\\s*$', '') WHEN m <> '' THEN regexp_replace(r, '[ivxlcIVXLC]{{1,6}}\\s*$', '') ELSE r END, '\\s+$', '') AS title FROM e WHERE d <> '' OR m IN ('', 'xiv')"""
)
def toc_parse(spark, sf_dir):
    row = F.when(F.col("doc_id") % 7 == 6, F.concat(F.lit("第Ⅱ部 "), "source", F.lit(" xiv"))).otherwise(made_heading())
    e = table(spark, sf_dir, "documents").select("doc_id", row.alias("r"), contents.parse_row(row).alias("e")).where("e is not null")
    roman = F.regexp_extract("r", r"([ivxlcIVXLC]{1,6})\s*$", 1)
    return longs(e.where((~F.col("e.is_roman")) | (roman == "xiv")).select("doc_id", "e.level", "e.is_roman", "e.page_num", "e.title"))


@query()
def toc_numbers(spark, sf_dir):
    """C2 is a fold; tests hold it against a loop."""
    l = geometry(spark, sf_dir)
    rows = l.select("page", "ord", F.when(F.col("ord") % 3 == 2, F.col("ord").cast("string")).otherwise(F.concat(F.lit("第"), F.col("ord") + 1, F.lit("章 x"))).alias("row_text"))
    rows = rows.select(F.col("page").alias("book_id"), F.lit(1).alias("page"), F.col("ord").alias("row"), "row_text")
    return longs(contents.entries(rows))


CONV = "(SELECT conv_id AS book_id, turn AS seq, role, text FROM conversations)"


def conversation_blocks(spark, sf_dir) -> DataFrame:
    """A conversation as a book: users' turns are large headings named by their first word, others paragraphs."""
    c = table(spark, sf_dir, "conversations")
    user, title = F.col("role") == "user", token(F.col("text"))
    none = {"n_row": "int", "n_col": "int", "cells": render_cells, "src": "string", "alt": "string", "box": "array<double>", "id": "string"}
    return c.select(
        F.col("conv_id").alias("book_id"), F.col("turn").alias("seq"), F.when(user, "heading").otherwise("para").alias("kind"), F.when(user, "大").alias("level"),
        F.when(user, F.array(title)).otherwise(F.array("text")).alias("lines"), F.col("turn").cast("int").alias("page"), F.lit(None).cast("array<int>").alias("pages"), F.lit(None).cast("string").alias("text"),
        F.col("role"), *(F.lit(None).cast(t).alias(k) for k, t in none.items()),
    )


render_cells = block_plan.CELLS


@query(
    f"""SELECT book_id, seq FROM (SELECT *, last_value(CASE role WHEN 'system' THEN true WHEN 'user' THEN false END IGNORE NULLS) OVER (PARTITION BY book_id ORDER BY seq) AS i FROM {CONV}) WHERE NOT coalesce(i, false)"""
)
def drop_toc_section(spark, sf_dir):
    b = conversation_blocks(spark, sf_dir)
    system = F.col("role") == "system"
    b = b.withColumn("kind", F.when(system, "heading").otherwise(F.col("kind"))).withColumn("lines", F.when(system, F.array(F.lit(" 目次"))).otherwise(F.col("lines")))
    return block_plan.without_printed_contents(b).select("book_id", "seq")


@query(f"SELECT doc_id AS book_id, count(*) AS n_lines, first(line_no % 5 ORDER BY line_no) AS page FROM {LINES} WHERE line_no % 5 <> 2 GROUP BY 1")
def drop_pages(spark, sf_dir):
    l = doc_lines(spark, sf_dir).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("x"))
    pages = F.transform("x", lambda s: (s["line_no"] % 5).cast("int"))
    b = l.select(F.col("doc_id").alias("book_id"), F.lit("para").alias("kind"), F.col("x.line").alias("lines"), pages.alias("pages"), pages[0].alias("page"))
    gone = b.select("book_id", F.lit(2).alias("page"))
    return longs(block_plan.drop_pages(b, gone).select("book_id", F.size("lines").alias("n_lines"), "page"))


PARTS = f"(SELECT book_id, seq, role, text, CASE WHEN role = 'user' THEN seq % 3 END AS num, seq // 2 AS page FROM {CONV})"


@query(
    f"""WITH b AS {PARTS}, c AS (SELECT book_id, page, sum(length(text)) AS chars FROM b WHERE role <> 'user' GROUP BY 1, 2), h AS (SELECT b.book_id, b.seq, b.num, coalesce(c.chars, 0) <= 100 AS light FROM b LEFT JOIN c USING (book_id, page) WHERE b.num IS NOT NULL),
    k AS (SELECT book_id, count(*) AS n, count(*) FILTER (light) AS l, count(DISTINCT num) FILTER (light) AS d FROM h GROUP BY 1)
    SELECT b.book_id, b.seq, CASE WHEN b.num IS NULL OR (NOT h.light AND k.n >= 2 AND k.l >= 1 AND (k.d <> k.l OR EXISTS (SELECT 1 FROM h g WHERE g.book_id = b.book_id AND g.light AND g.num = b.num))) THEN 'para' ELSE 'heading' END AS kind
    FROM b LEFT JOIN h ON h.book_id = b.book_id AND h.seq = b.seq LEFT JOIN k ON k.book_id = b.book_id"""
)
def part_demote(spark, sf_dir):
    b = conversation_blocks(spark, sf_dir)
    part = F.concat(F.lit("第"), F.substring(F.lit(P.ROMAN_PARTS), (F.col("seq") % 3 + 1).cast("int"), F.lit(1)), F.lit("部"))
    b = b.withColumn("lines", F.when(F.col("role") == "user", F.array(part)).otherwise(F.col("lines"))).withColumn("page", F.floor(F.col("seq") / 2).cast("int"))
    return structure.demote_part_headings(b).select("book_id", "seq", "kind")


SPLIT = f"""(WITH b AS (SELECT *, CASE WHEN role = 'user' THEN regexp_extract(text, '^[A-Za-z]+') END AS title FROM {CONV}),
    p AS (SELECT *, last_value(title IGNORE NULLS) OVER (PARTITION BY book_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM b),
    k AS (SELECT * FROM p WHERE NOT coalesce(title <> '' AND title = prev, false)),
    s AS (SELECT *, CASE WHEN title IS NOT NULL OR row_number() OVER (PARTITION BY book_id ORDER BY seq) = 1 THEN 1 ELSE 0 END AS st FROM k)
    SELECT book_id, seq, title, text, (sum(st) OVER (PARTITION BY book_id ORDER BY seq) - 1)::BIGINT AS chapter_no FROM s)"""


@query(f"SELECT book_id, seq, chapter_no, 'ch' || lpad(chapter_no::VARCHAR, 3, '0') || '.xhtml' AS file FROM {SPLIT}")
def chapter_split(spark, sf_dir):
    return longs(structure.split_chapters(conversation_blocks(spark, sf_dir))[0].select("book_id", "seq", "chapter_no", "file"))


@query(f"SELECT book_id, chapter_no, count(*) AS blocks, sum(CASE WHEN title IS NULL THEN length(text) ELSE length(title) END)::BIGINT AS chars FROM {SPLIT} GROUP BY 1, 2")
def chapter_summary(spark, sf_dir):
    b = structure.split_chapters(conversation_blocks(spark, sf_dir))[0]
    return longs(b.groupBy("book_id", "chapter_no").agg(F.count("*").alias("blocks"), F.sum(F.length(F.col("lines")[0])).alias("chars")))


@query(f"SELECT book_id, 'p' || min(seq) || CASE WHEN min(seq) = max(seq) THEN '' ELSE '〜p' || max(seq) END AS pages FROM {SPLIT} WHERE chapter_no = 0 GROUP BY 1 HAVING arg_min(title, seq) IS NULL AND first(title IS NULL ORDER BY seq)")
def chapter_orphans(spark, sf_dir):
    b = structure.split_chapters(conversation_blocks(spark, sf_dir))[0]
    return structure.chapters_without_entry(b).select("book_id", "pages")


@query(
    f"""WITH n AS (SELECT book_id, chapter_no, CASE WHEN title = '' THEN '（無題）' ELSE title END AS title, row_number() OVER (PARTITION BY book_id ORDER BY seq) AS node_id FROM {SPLIT} WHERE title IS NOT NULL)
    SELECT book_id, node_id, title, 1::BIGINT AS depth, 'text/ch' || lpad(chapter_no::VARCHAR, 3, '0') || '.xhtml' AS href, node_id AS play_order FROM n"""
)
def nav_numbering(spark, sf_dir):
    nav = structure.split_chapters(conversation_blocks(spark, sf_dir))[1]
    return longs(structure.play_order(nav).select("book_id", "node_id", "title", "depth", "href", "play_order"))


@query(
    f"""WITH n AS (SELECT book_id, row_number() OVER (PARTITION BY book_id ORDER BY seq) AS node_id, (chapter_no * 7 % 5)::BIGINT AS pos FROM {SPLIT} WHERE title IS NOT NULL)
    SELECT book_id, node_id, pos, before FROM (SELECT *, lag(pos) OVER (PARTITION BY book_id ORDER BY node_id) AS before FROM n) WHERE pos < before"""
)
def nav_order_check(spark, sf_dir):
    blocks, nav = structure.split_chapters(conversation_blocks(spark, sf_dir))
    spine = blocks.select("book_id", F.concat(F.lit("text/"), "file").alias("href"), (F.col("chapter_no") * 7 % 5).alias("pos")).distinct()
    return longs(structure.nav_order_problems(nav, spine).select("book_id", "node_id", "pos", "before"))


CHUNKS = f"""(WITH RECURSIVE l AS (SELECT doc_id, line_no, line, length(line) AS n FROM {LINES}), r AS (SELECT doc_id, line_no, n + 1 AS size, 1 AS many, 0 AS chunk FROM l WHERE line_no = 1
    UNION ALL SELECT l.doc_id, l.line_no, CASE WHEN r.size >= 300 OR r.many >= 5 THEN l.n + 1 ELSE r.size + l.n + 1 END, CASE WHEN r.size >= 300 OR r.many >= 5 THEN 1 ELSE r.many + 1 END, CASE WHEN r.size >= 300 OR r.many >= 5 THEN r.chunk + 1 ELSE r.chunk END
    FROM r JOIN l ON l.doc_id = r.doc_id AND l.line_no = r.line_no + 1) SELECT r.doc_id, r.chunk, r.line_no, l.line FROM r JOIN l USING (doc_id, line_no))"""


def _chunks(spark, sf_dir) -> DataFrame:
    return corrections.chunk_lines(doc_lines(spark, sf_dir), ["doc_id"], 300, 5)


@query(f"SELECT doc_id, chunk::BIGINT AS chunk_idx, (min(line_no) - 1)::BIGINT AS \"offset\", count(*) AS n_lines FROM {CHUNKS} GROUP BY 1, 2")
def chunk_lines(spark, sf_dir):
    return longs(_chunks(spark, sf_dir).select("doc_id", "chunk_idx", "offset", F.size("lines").alias("n_lines")))


@query(f"SELECT doc_id, chunk::BIGINT AS chunk_idx, substr(sha256('m' || chr(0) || 'ctx' || chr(0) || (min(line_no) - 1) || chr(0) || string_agg(line, chr(0) ORDER BY line_no)), 1, 12) AS key FROM {CHUNKS} GROUP BY 1, 2")
def chunk_key(spark, sf_dir):
    return longs(_chunks(spark, sf_dir).select("doc_id", "chunk_idx", corrections.chunk_key(F.lit("m"), F.lit("ctx"), F.col("offset"), F.col("lines")).alias("key")))


EDIT_SQL = f"(SELECT doc_id, string_split(text, chr(10))[1] AS line, {TOKEN.format('text')} AS t, doc_id % 7 AS k FROM documents)"


@query(
    f"""WITH e AS (SELECT doc_id, line, CASE WHEN k = 5 THEN '' ELSE t END AS b, CASE k WHEN 0 THEN upper(t) || '1' WHEN 1 THEN t WHEN 2 THEN t || chr(10) WHEN 3 THEN t || repeat('x', 40) WHEN 4 THEN t || '《' WHEN 6 THEN '[' || t ELSE 'x' END AS a, CASE WHEN k = 6 THEN 9 ELSE 1 END AS n FROM {EDIT_SQL}),
    s AS (SELECT *, replace(replace(replace(replace(a, '[', '〔'), ']', '〕'), '［', '〔'), '］', '〕') AS c FROM e)
    SELECT doc_id, CASE WHEN n > 1 THEN '行番号が範囲外' WHEN contains(a, chr(10)) THEN '改行を含む' WHEN b = '' OR b = c THEN '変更なし' WHEN abs(length(c) - length(b)) > greatest(4, length(b)) THEN '変更量が大きすぎる'
    WHEN contains(c, '《') THEN 'ルビ記号が不整合' WHEN (length(line) - length(replace(line, b, ''))) // length(b) <> 1 THEN 'before が行に一意に見つからない' ELSE '' END AS reason FROM s"""
)
def edit_validate(spark, sf_dir):
    t, k = token(F.col("text")), F.col("doc_id") % 7
    after = F.when(k == 0, F.concat(F.upper(t), F.lit("1"))).when(k == 1, t).when(k == 2, F.concat(t, F.lit("\n"))).when(k == 3, F.concat(t, F.lit("x" * 40))).when(k == 4, F.concat(t, F.lit("《"))).when(k == 6, F.concat(F.lit("["), t)).otherwise("x")
    before, line_no = F.when(k == 5, "").otherwise(t), F.when(k == 6, 9).otherwise(1)
    v = corrections.verdict(F.split("text", "\n")[0], F.lit(1), line_no, before, after)
    return table(spark, sf_dir, "documents").select("doc_id", v.alias("v")).select("doc_id", "v.reason")


# A book is 64 successive ids, so books grow in number, not in size.
FIXES = f"(SELECT doc_id // 64 AS book_id, doc_id AS ord, row_number() OVER (PARTITION BY doc_id // 64 ORDER BY doc_id) AS page, {TOKEN.format('text')} AS before FROM documents)"
FIX_LINES = "(SELECT doc_id // 64 AS book_id, doc_id AS line_id, row_number() OVER (PARTITION BY doc_id // 64 ORDER BY doc_id) + doc_id % 2 AS page, text AS line FROM documents)"


def _fix_books(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "documents").withColumn("book_id", F.floor(F.col("doc_id") / 64))
    return d.withColumn("n", F.row_number().over(Window.partitionBy("book_id").orderBy("doc_id")))


@query(
    f"""WITH h AS (SELECT f.book_id, f.ord, l.line_id, l.page = f.page AS here FROM {FIXES} f JOIN {FIX_LINES} l ON l.book_id = f.book_id AND abs(l.page - f.page) <= 1 AND f.before <> '' AND (length(l.line) - length(replace(l.line, f.before, ''))) // length(f.before) = 1),
    c AS (SELECT book_id, ord, count(*) FILTER (here) AS a, count(*) FILTER (NOT here) AS b, min(line_id) FILTER (here) AS x, min(line_id) FILTER (NOT here) AS y FROM h GROUP BY 1, 2)
    SELECT f.book_id, f.ord, CASE WHEN f.before = '' THEN 'empty' WHEN c.a > 1 THEN 'several' WHEN c.a = 1 OR c.b = 1 THEN '' ELSE 'not found' END AS reason, CASE WHEN f.before = '' THEN NULL WHEN c.a = 1 THEN x WHEN c.a = 0 AND c.b = 1 THEN y END AS line_id FROM {FIXES} f LEFT JOIN c USING (book_id, ord)"""
)
def fix_apply_unique(spark, sf_dir):
    d = _fix_books(spark, sf_dir)
    fixes = d.select("book_id", F.col("doc_id").alias("ord"), F.col("n").cast("long").alias("page"), token(F.col("text")).alias("before"), F.lit("x").alias("after"))
    lines = d.select("book_id", F.col("doc_id").alias("line_id"), (F.col("n") + F.col("doc_id") % 2).alias("page"), F.col("text").alias("line"))
    return longs(corrections.unique_matches(lines, fixes, ["book_id"]).select("book_id", "ord", "reason", "line_id"))


@query()
def fix_apply_ordered(spark, sf_dir):
    """L10 in order, where fixes meet each other's results; tests hold goldens."""
    d = _fix_books(spark, sf_dir)
    fixes = d.select("book_id", F.col("n").alias("ord"), F.col("n").alias("page"), token(F.col("text")).alias("before"), F.lit("x").alias("after"))
    lines = d.select("book_id", F.col("doc_id").alias("line_id"), F.col("n").alias("page"), F.col("text").alias("line"))
    return longs(corrections.apply_fixes(lines, fixes, ["book_id"])[1])


@query("SELECT doc_id, CASE doc_id % 3 WHEN 2 THEN 0 ELSE 1 END::BIGINT AS n_edits, CASE doc_id % 3 WHEN 2 THEN NULL ELSE doc_id END AS line FROM documents")
def answers_parse(spark, sf_dir):
    one = F.concat(F.lit('[{"line": '), F.col("doc_id"), F.lit(', "before": "a", "after": "b", "why": "w"}]'))
    k = F.col("doc_id") % 3
    answer = F.when(k == 0, F.concat(F.lit("so:\n```json\n"), one, F.lit("\n```\n"))).when(k == 1, F.concat(F.lit("here "), one, F.lit(" end"))).otherwise("none [")
    e = corrections.extract_json(answer)
    return longs(table(spark, sf_dir, "documents").select("doc_id", F.size(e).alias("n_edits"), F.get(e, F.lit(0))["line"].cast("long").alias("line")))


@query("SELECT doc_id, '〔a〕［＃x［y］' || '〔' || source || '〕' AS clean FROM documents")
def sanitize(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", corrections.sanitize(F.concat(F.lit("[a]［＃x［y］["), "source", F.lit("］"))).alias("clean"))


@query("SELECT doc_id, md5(text) AS key FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS k FROM documents) WHERE k = 1")
def meta_first_wins(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.lit(0).alias("request"), "doc_id", F.md5(F.col("text").cast("binary")).alias("key"))
    return metadata.first_wins(docs, ["request"], F.col("key"), "doc_id").select("doc_id", "key")


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN source ELSE 't' || doc_id END AS title, CASE WHEN doc_id % 5 = 0 THEN lang ELSE '' END AS author FROM documents")
def meta_fill(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    given = d.select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.col("source")).otherwise("").alias("title"), F.lit("").alias("author"))
    found = d.select("doc_id", F.concat(F.lit("t"), "doc_id").alias("title"), F.when(F.col("doc_id") % 5 == 0, F.col("lang")).alias("author"))
    return metadata.fill_blanks(given, found, "doc_id")


@query(
    """WITH m AS (SELECT split_part(url, '/', 3) AS book_id, 'i' || page_id AS id, 'p/' || page_id % 40 AS path FROM pages), e AS (SELECT split_part(url, '/', 3) AS book_id, 'p/' || page_id * 3 % 50 AS name FROM pages)
    SELECT book_id, 'V4' AS rule, id || ' ' || path AS detail FROM m WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.book_id = m.book_id AND e.name = m.path) UNION ALL SELECT book_id, 'V12', name FROM e WHERE NOT EXISTS (SELECT 1 FROM m WHERE e.book_id = m.book_id AND e.name = m.path)"""
)
def link_manifest_check(spark, sf_dir):
    p = table(spark, sf_dir, "pages").withColumn("book_id", F.split("url", "/")[2])
    manifest = p.select("book_id", F.concat(F.lit("i"), "page_id").alias("id"), F.concat(F.lit("p/"), F.col("page_id") % 40).alias("path"))
    entries = p.select("book_id", F.concat(F.lit("p/"), F.col("page_id") * 3 % 50).alias("name"))
    return checks.missing_files(manifest, entries).unionByName(checks.undeclared_files(manifest, entries))


def _without_breaks(b: DataFrame) -> DataFrame:
    return b.withColumn("lines", F.transform("lines", lambda l: F.replace(l, F.lit("\n"), F.lit(" "))))


CLEAN = norm_sql("replace(text, chr(10), ' ')")


@query(
    f"""SELECT book_id, chapter_no, '<section>' || string_agg(CASE WHEN title IS NULL THEN '<p>' || {escape_sql(CLEAN)} || '</p>' ELSE '<h1>' || title || '</h1>' END, chr(10) ORDER BY seq) FILTER (title IS NOT NULL AND title <> '' OR title IS NULL AND {CLEAN} <> '') || '</section>' AS html FROM {SPLIT} GROUP BY 1, 2"""
)
def render_doc(spark, sf_dir):
    b = _without_breaks(structure.split_chapters(conversation_blocks(spark, sf_dir))[0])
    h = render.blocks_html(b, vertical=False)
    html = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("html") != "", F.struct("seq", "html")))), lambda s: s["html"]), "\n")
    g = h.groupBy("book_id", "chapter_no").agg(F.concat(F.lit("<section>"), F.when(F.count(F.when(F.col("html") != "", 1)) > 0, html), F.lit("</section>")).alias("html"))
    return longs(g)


@query(f"SELECT book_id, regexp_replace(string_agg(CASE WHEN role <> 'user' THEN CASE WHEN {CLEAN} <> '' THEN '　' || {CLEAN} END WHEN t = '' THEN '［＃改ページ］' ELSE '［＃改ページ］' || chr(10) || t || '［＃「' || t || '」は大見出し］' END, chr(10) ORDER BY seq), '^\\n+', '') AS body FROM (SELECT *, {TOKEN.format('text')} AS t FROM {CONV}) GROUP BY 1")
def render_plain_text(spark, sf_dir):
    b = _without_breaks(conversation_blocks(spark, sf_dir))
    return render.plain_text(b, "fig").select("book_id", F.col("text").alias("body"))


@query(
    """WITH l AS (SELECT l_orderkey, l_linenumber, min(l_returnflag) AS l_returnflag, min(l_partkey) AS l_partkey FROM lineitem GROUP BY 1, 2), g AS (SELECT l_orderkey, max(l_linenumber) AS n FROM l GROUP BY 1), p AS (SELECT l_orderkey, unnest(range(1, n + 1)) AS r FROM g),
    t AS (SELECT p.l_orderkey, p.r, '<tr>' || CASE WHEN l.l_linenumber IS NULL THEN '<td></td><td></td>' WHEN l.l_linenumber = 1 THEN '<td colspan="2">' || l.l_returnflag || '</td>' ELSE '<td>' || l.l_returnflag || '</td><td>' || l.l_partkey || '</td>' END || '</tr>' AS tr FROM p LEFT JOIN l ON l.l_orderkey = p.l_orderkey AND l.l_linenumber = p.r)
    SELECT l_orderkey, '<table class="h-table">' || chr(10) || string_agg(tr, chr(10) ORDER BY r) || chr(10) || '</table>' AS html FROM t GROUP BY 1"""
)
def table_render(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_returnflag").alias("l_returnflag"), F.min("l_partkey").alias("l_partkey"))
    n, null = F.col("l_linenumber"), F.lit(None).cast("int")
    cell = lambda c, span, text: F.struct(n.alias("row"), F.lit(c).alias("col"), null.alias("row_span"), span.alias("col_span"), text.alias("contents"))
    first = F.array(cell(1, F.when(n == 1, 2), F.col("l_returnflag")), cell(2, null, F.col("l_partkey").cast("string")))
    t = l.groupBy("l_orderkey").agg(F.max(n).alias("n_row"), F.flatten(F.collect_list(first)).alias("cells")).withColumn("n_col", F.lit(2))
    return render.tables_html(t, ["l_orderkey"])


@query(f"SELECT book_id, '<ol>' || string_agg('<li><a href=\"text/ch' || lpad(chapter_no::VARCHAR, 3, '0') || '.xhtml\">' || CASE WHEN title = '' THEN '（無題）' ELSE title END || '</a></li>', '' ORDER BY seq) || '</ol>' AS html FROM {SPLIT} WHERE title IS NOT NULL GROUP BY 1")
def nav_render(spark, sf_dir):
    return render.nav_lists(structure.split_chapters(conversation_blocks(spark, sf_dir))[1], vertical=False)


@query("SELECT page_id AS page, 'p' || page_id AS src, greatest(0, page_id % 9 - 6)::BIGINT AS \"left\", greatest(0, page_id % 50 - 6)::BIGINT AS top, least(100, page_id % 120 + 6)::BIGINT AS \"right\", least(80, page_id % 90 + 6)::BIGINT AS bottom FROM pages")
def crop_boxes(spark, sf_dir):
    p, n = table(spark, sf_dir, "pages"), F.col("page_id")
    f = p.select(F.lit("b").alias("book_id"), n.alias("page"), F.concat(F.lit("p"), n).alias("src"), F.array(n % 9 + 0.7, n % 50 + 0.2, n % 120 + 0.9, n % 90 + 0.5).cast("array<double>").alias("box"), F.lit(100).alias("width"), F.lit(80).alias("height"))
    return longs(render.crop_boxes(f).drop("book_id"))


@query("SELECT x::BIGINT AS page FROM (SELECT unnest(range(2, (SELECT 2 * max(page_id) + 2 FROM pages))) AS x) WHERE x NOT IN (SELECT 2 * page_id FROM pages)")
def missing_pages(spark, sf_dir):
    """All pages of the table stand at even places; what lies between them is missing."""
    have = table(spark, sf_dir, "pages").select((2 * F.col("page_id")).cast("int").alias("page"))
    last = have.agg(F.max("page")).first()[0] or 0
    return longs(sources.missing_pages(spark, (2, last + 1), last + 1, have))


@query("SELECT doc_id AS book_id, unnest(range(1, len(l) + 1))::BIGINT AS page, unnest(l) AS layer FROM (SELECT doc_id, string_split(text, '.') AS l FROM documents)")
def text_layer(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("book_id"), F.replace("text", F.lit("."), F.lit("\f")).alias("text"))
    return longs(sources.text_layer(d))


@query()
def package_check(spark, sf_dir):
    """V1-V12 over packages built of conversations, zipped and read again; tests break packages on purpose."""
    blocks, nav = structure.split_chapters(_without_breaks(conversation_blocks(spark, sf_dir)).withColumn("book_id", F.col("book_id").cast("string")))
    blocks, nav = written(blocks, "blocks"), written(nav, "nav")
    books = blocks.groupBy("book_id").agg(F.concat(F.lit("text/"), F.min("file")).alias("first_href")).withColumn("title", F.concat(F.lit("t"), "book_id")).withColumn("identifier", F.concat(F.lit("urn:x:"), "book_id"))
    books = books.withColumn("author", F.lit("")).withColumn("publisher", F.lit("p")).withColumn("modified", F.lit("2000-01-01T00:00:00Z"))
    return build_package(blocks, nav, books)[1]


@query()
def build_blocks(spark, sf_dir):
    """G16 over pages made of documents: each line a word box, each document a page of its source's book."""
    d = table(spark, sf_dir, "documents")
    lines = F.split("text", "\n")
    corner = lambda x, y: F.array(x.cast("double"), y.cast("double"))

    def word(l: Column, k: Column) -> Column:
        x0, y0 = F.when(l.rlike("^[A-Z]"), 130).otherwise(100), k * 30 + 80
        return F.struct(F.array(corner(x0, y0), corner(F.lit(900), y0), corner(F.lit(900), y0 + 24), corner(x0, y0 + 24)).alias("points"), l.alias("content"), F.lit("horizontal").alias("direction"))

    para = F.struct(F.array(*map(F.lit, (90.0, 70.0, 910.0, 1e9))).alias("box"), F.lit("").alias("contents"), F.lit("horizontal").alias("direction"), F.lit(1).alias("order"), F.lit(None).cast("string").alias("role"))
    pages = d.select(
        F.col("source").alias("book_id"), F.col("doc_id").cast("int").alias("page"), F.struct(F.lit(1200).alias("h"), F.lit(1000).alias("w")).alias("image_size"), F.transform(lines, word).alias("words"),
        F.array(para).alias("paragraphs"), F.array().cast(f"array<struct<box:array<double>,n_row:int,n_col:int,order:int,cells:{block_plan.CELLS}>>").alias("tables"), F.array().cast("array<struct<box:array<double>,order:int,paragraphs:array<struct<contents:string>>>>").alias("figures"),
    )
    layer = d.select(F.col("source").alias("book_id"), F.col("doc_id").cast("int").alias("page"), F.lit("").alias("layer"))
    blocks = block_plan.build_blocks(pages, layer)[0]
    return longs(blocks.select("book_id", "seq", "kind", "page", F.size("lines").alias("n_lines")))


@query(
    f"""SELECT doc_id, array_to_string(CASE WHEN len(l) >= 3 THEN list_append(l[1:len(l) - 1], CASE WHEN starts_with(e, '――') THEN e ELSE '――' || e END) ELSE l END, chr(10)) AS title
    FROM (SELECT doc_id, l, regexp_replace(l[len(l)], '[{P.DASHES}]+$', '――') AS e FROM (SELECT doc_id, string_split(text || CASE doc_id % 3 WHEN 0 THEN '—' WHEN 1 THEN '--' ELSE '' END, chr(10)) AS l FROM documents))"""
)
def title_dash(spark, sf_dir):
    """T8 over the lines of whole texts, some of which end in a dash."""
    end = F.when(F.col("doc_id") % 3 == 0, "—").when(F.col("doc_id") % 3 == 1, "--").otherwise("")
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(X.subtitle_dash(F.split(F.concat("text", end), "\n", -1)), "\n").alias("title"))


VOCABULARY = [*P.FRONT_BACK, *P.UNNUMBERED_CHAPTERS, "本文"]
TITLE_SQL = f"""[{", ".join(f"'{p}'" for p in ("", "", *P.PREFIXES))}][1 + (doc_id // 7) % {len(P.PREFIXES) + 2}] || [{", ".join(f"'{w}'" for w in VOCABULARY)}][1 + doc_id % {len(VOCABULARY)}]
    || CASE (doc_id // 3) % 5 WHEN 0 THEN '' WHEN 1 THEN doc_id::VARCHAR WHEN 2 THEN 'xiv' WHEN 3 THEN ' 12' ELSE {TOKEN.format("text")} END"""


def unpaged_sql(e: str) -> str:
    """T9 in SQL."""
    word = f"regexp_extract({e}, '{P.NUMBERED_PAGE_RE}', 1)"
    return f"CASE WHEN {word} <> '' THEN {word} ELSE {e} END"


@query(
    f"""SELECT doc_id, unpaged, CASE WHEN regexp_matches(z, '^{P.PREFIX}{P.any_of([w for w in P.FRONT_BACK if w not in P.CONTENTS])}{WORD_END_SQL}') OR regexp_matches(z, '^{P.any_of(P.UNNUMBERED_CHAPTERS)}{WORD_END_SQL}') THEN z ELSE '' END AS front_back
    FROM (SELECT doc_id, {unpaged_sql("x")} AS unpaged, {unpaged_sql("y")} AS z FROM (SELECT doc_id, x, {norm_sql("x")} AS y FROM (SELECT doc_id, {TITLE_SQL} AS x FROM documents)))"""
)
def front_back_title(spark, sf_dir):
    """T9 and T10 over titles of the vocabulary with page numbers or words behind them; further lines don't count."""
    d = F.col("doc_id")
    pick = lambda words, k: F.element_at(F.array(*map(F.lit, words)), (k + 1).cast("int"))
    k = F.floor(d / 3) % 5
    end = F.when(k == 0, "").when(k == 1, d.cast("string")).when(k == 2, "xiv").when(k == 3, " 12").otherwise(token(F.col("text")))
    title = F.concat(pick(("", "", *P.PREFIXES), F.floor(d / 7) % (len(P.PREFIXES) + 2)), pick(VOCABULARY, d % len(VOCABULARY)), end)
    return table(spark, sf_dir, "documents").select("doc_id", X.without_page_number(title).alias("unpaged"), X.front_back_title(F.concat(title, F.lit("\n"), "text")).alias("front_back"))


@query(
    f"""SELECT doc_id, coalesce((regexp_full_match(t, '[0-9]+') AND regexp_full_match(h, '[0-9]+')) OR (regexp_full_match(t, '[A-Z]+') AND regexp_full_match(h, '[A-Z]+') AND least(length(t), length(h)) = 1), false) AS split
    FROM (SELECT doc_id, regexp_extract(a, '[{P.CJK}]([0-9A-Za-z]+)$', 1) AS t, regexp_extract(b, '^([0-9A-Za-z]+)[{P.CJK}]', 1) AS h
    FROM (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '字' || (doc_id % 100) WHEN 1 THEN '字' || upper({TOKEN.format("text")}) WHEN 2 THEN '、A' ELSE text END AS a,
    CASE (doc_id // 4) % 4 WHEN 0 THEN (doc_id % 7) || '字' WHEN 1 THEN 'B字' WHEN 2 THEN 'BC。' ELSE text END AS b FROM documents))"""
)
def split_token(spark, sf_dir):
    """T4 over line ends and starts beside CJK text, and over whole texts."""
    d, t = F.col("doc_id"), F.col("text")
    a = F.when(d % 4 == 0, F.concat(F.lit("字"), d % 100)).when(d % 4 == 1, F.concat(F.lit("字"), F.upper(token(t)))).when(d % 4 == 2, "、A").otherwise(t)
    k = F.floor(d / 4) % 4
    b = F.when(k == 0, F.concat(d % 7, F.lit("字"))).when(k == 1, "B字").when(k == 2, "BC。").otherwise(t)
    return table(spark, sf_dir, "documents").select("doc_id", F.coalesce(X.is_split_token(a, b), F.lit(False)).alias("split"))


@query(
    """SELECT c_custkey, concat_ws(chr(10), '書名: ' || c_name, CASE WHEN c_custkey % 2 = 0 THEN '著者: ' || c_mktsegment END, '刊行: ' || c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'ISBN: 978' END) AS summary,
    CASE WHEN c_custkey % 4 = 0 THEN c_name ELSE c_name || '、' || c_mktsegment END AS authors FROM customer"""
)
def record_summary(spark, sf_dir):
    """M7, and T23 of names with a repeated, an empty and sometimes a second one."""
    k, n, s = F.col("c_custkey"), F.col("c_name"), F.col("c_mktsegment")
    c = table(spark, sf_dir, "customer").select(
        k, n.alias("title"), F.when(k % 2 == 0, s).otherwise("").alias("author"), F.lit("").alias("publisher"), F.lit(None).cast("string").alias("series"),
        k.cast("string").alias("pubdate"), F.lit("").alias("extent"), F.when(k % 3 == 0, "978").otherwise("").alias("isbn"),
        metadata.join_authors(F.array(F.concat(n, F.lit(" 著")), F.lit(" "), F.when(k % 4 == 0, n).otherwise(F.concat(s, F.lit("、1900-1980"))), n)).alias("authors"),
    )
    return c.select("c_custkey", F.array_join(metadata.summary_lines(), "\n").alias("summary"), "authors")


@query(
    f"""SELECT p_partkey, CASE WHEN ok THEN body || c ELSE '' END AS isbn, p_name AS title, p_name AS author, 'P' AS publisher, '' AS series, CASE p_partkey % 3 WHEN 0 THEN '1996.3' WHEN 1 THEN '1996' ELSE 'n.d.' END AS pubdate,
    '' AS extent, '{metadata.FIRST_SOURCE}' AS source, CASE WHEN ok THEN '{metadata.RECORD_LINK}' || body || c ELSE '' END AS link
    FROM (SELECT *, (10 - list_sum(list_transform(range(1, 13), lambda i: substr(body, i, 1)::INT * CASE WHEN i % 2 = 0 THEN 3 ELSE 1 END)) % 10) % 10 AS c, p_partkey % 4 <> 0 AS ok
    FROM (SELECT *, '978' || lpad(p_partkey::VARCHAR, 9, '0') AS body FROM part)) WHERE p_partkey % 7 <> 0"""
)
def record_parse(spark, sf_dir):
    """M1 over records with and without contributors, with right and wrong check digits, and without a title."""
    k, n = F.col("p_partkey"), F.col("p_name")
    body = F.concat(F.lit("978"), F.lpad(k.cast("string"), 9, "0"))
    check = metadata.check_digit_13(body).cast("int")
    isbn = F.concat(F.lit("ISBN "), body, F.lit("-"), F.when(k % 4 == 0, (check + 1) % 10).otherwise(check).cast("string"))
    person = lambda c: F.struct(F.struct(c.alias("content")).alias("PersonName"))
    people = F.when(k % 5 == 0, F.lit(None)).otherwise(F.array(person(F.concat(n, F.lit(" 著"))), person(F.lit(None).cast("string"))))
    date = F.when(k % 3 == 0, "1996-03").when(k % 3 == 1, "1996").otherwise(" n.d. ")
    summary = F.struct(isbn.alias("isbn"), F.when(k % 7 == 0, " ").otherwise(F.concat(F.lit(" "), n)).alias("title"), F.lit(None).cast("string").alias("series"), F.lit("P ").alias("publisher"), date.alias("pubdate"), F.concat(n, F.lit(", 1900-1980")).alias("author"))
    record = F.struct(F.struct(F.struct(people.alias("Contributor")).alias("DescriptiveDetail")).alias("onix"), summary.alias("summary"))
    parsed = table(spark, sf_dir, "part").select("p_partkey", metadata.parse_openbd(record).alias("m"))
    return parsed.where("m is not null").select("p_partkey", "m.*")


NODES_SQL = """(SELECT *, dense_rank() OVER (PARTITION BY book_id ORDER BY f) AS play FROM (SELECT *, min(id) OVER (PARTITION BY book_id, href) AS f FROM (
    SELECT o_custkey AS book_id, o_orderkey * 10 AS id, NULL AS parent, 1 AS depth, 'n' || o_orderkey || ' <&>' AS title, 'text/' || o_orderkey % 3 || '.xhtml' AS href FROM orders
    UNION SELECT o_custkey, o_orderkey * 10 + l_linenumber, o_orderkey * 10, 2, 'l' || l_linenumber, 'text/' || o_orderkey % 3 || '.xhtml#s' || l_linenumber % 4 FROM lineitem JOIN orders ON l_orderkey = o_orderkey)))"""


def order_nav(spark, sf_dir) -> DataFrame:
    """Orders of a customer as chapters, their lines as sections, some of which share a target."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("book_id"), "o_orderkey").distinct()
    l = o.join(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber").distinct(), "o_orderkey")
    k, n = F.col("o_orderkey"), F.col("l_linenumber")
    file = F.concat(F.lit("text/"), k % 3, F.lit(".xhtml"))
    top = o.select("book_id", (k * 10).alias("node_id"), F.lit(None).cast("long").alias("parent_id"), F.lit(1).alias("depth"), F.concat(F.lit("n"), k, F.lit(" <&>")).alias("title"), file.alias("href"))
    return top.unionByName(l.select("book_id", (k * 10 + n).alias("node_id"), (k * 10).alias("parent_id"), F.lit(2).alias("depth"), F.concat(F.lit("l"), n).alias("title"), F.concat(file, F.lit("#s"), n % 4).alias("href")))


def order_books(nav: DataFrame) -> DataFrame:
    return nav.groupBy("book_id").agg(F.min_by("href", "node_id").alias("first_href")).withColumn("title", F.concat(F.lit("t&"), "book_id")).withColumn("identifier", F.concat(F.lit("urn:x:"), "book_id"))


POINT_SQL = f"'<navPoint id=\"navPoint-' || id || '\" playOrder=\"' || play || '\">' || chr(10) || '<navLabel><text>' || {escape_sql('title')} || '</text></navLabel>' || chr(10) || '<content src=\"' || href || '\"/>' || chr(10)"


def meta_sql(name: str, value: str) -> str:
    return f"'<meta name=\"dtb:{name}\" content=\"' || {value} || '\"/>' || chr(10)"


@query(
    f"""WITH n AS {NODES_SQL}, k AS (SELECT parent, string_agg({POINT_SQL} || '</navPoint>' || chr(10), '' ORDER BY id) AS kids FROM n WHERE depth = 2 GROUP BY 1),
    t AS (SELECT book_id, string_agg({POINT_SQL} || coalesce(kids, '') || '</navPoint>' || chr(10), '' ORDER BY id) AS points, max(CASE WHEN kids IS NULL THEN 1 ELSE 2 END) AS depth FROM n LEFT JOIN k ON k.parent = n.id WHERE n.depth = 1 GROUP BY 1)
    SELECT book_id, depth::BIGINT AS depth, '<head>' || chr(10) || {meta_sql("uid", "'urn:x:' || book_id")} || {meta_sql("depth", "depth")} || {meta_sql("totalPageCount", "'0'")} || {meta_sql("maxPageNumber", "'0'")} || '</head>' || chr(10)
    || '<docTitle><text>t&amp;' || book_id || '</text></docTitle>' || chr(10) || '<navMap>' || chr(10) || points || '</navMap>' || chr(10) || '</ncx>' || chr(10) AS ncx FROM t"""
)
def ncx_render(spark, sf_dir):
    """The document from its head on (what precedes is fixed), the depth and shared targets."""
    nav = written(order_nav(spark, sf_dir), "nav")
    out = render.ncx(structure.play_order(nav), order_books(nav)).join(structure.nav_depth(nav), "book_id")
    return longs(out.select("book_id", "depth", F.concat(F.lit("<head>"), F.substring_index("ncx", "<head>", -1)).alias("ncx")))


LINK_SQL = f"'<li><a href=\"' || href || '\">' || {escape_sql('title')} || '</a>'"


@query(
    f"""WITH n AS {NODES_SQL}, k AS (SELECT parent, '<ol>' || string_agg({LINK_SQL} || '</li>', '' ORDER BY id) || '</ol>' AS kids FROM n WHERE depth = 2 GROUP BY 1),
    t AS (SELECT book_id, '<ol>' || string_agg({LINK_SQL} || coalesce(kids, '') || '</li>', '' ORDER BY id) || '</ol>' AS list, arg_min(href, id) AS first FROM n LEFT JOIN k ON k.parent = n.id WHERE n.depth = 1 GROUP BY 1)
    SELECT book_id, '<body>' || chr(10) || '<nav epub:type="toc" id="toc"><h1>目次</h1>' || list || '</nav>' || chr(10) || '<nav epub:type="landmarks" id="landmarks" hidden=""><ol><li><a epub:type="cover" href="cover.xhtml">表紙</a></li><li><a epub:type="toc" href="nav.xhtml">目次</a></li><li><a epub:type="bodymatter" href="'
    || first || '">{render.UNTITLED}</a></li></ol></nav>' || chr(10) || '</body>' || chr(10) || '</html>' || chr(10) AS body FROM t"""
)
def nav_page(spark, sf_dir):
    """The whole navigation page of two levels, from its body on."""
    nav = written(order_nav(spark, sf_dir), "nav")
    out = render.nav_xhtml(nav, order_books(nav), vertical=False)
    return out.select("book_id", F.concat(F.lit("<body>"), F.substring_index("xhtml", "<body>", -1)).alias("body"))


@query(
    f"""SELECT doc_id, '{render.XHTML_HEAD.format(lang="ja")}' || {escape_sql("title")} || '</title>' || chr(10) || '<link rel="stylesheet" type="text/css" href="../style.css"/></head>' || chr(10) || '<body><section epub:type="' || kind || '">' || chr(10)
    || {escape_sql("text")} || chr(10) || '</section></body>' || chr(10) || '</html>' || chr(10) AS xhtml FROM (SELECT doc_id, text, source || ' <' || doc_id || '>' AS title, CASE WHEN doc_id % 2 = 0 THEN 'chapter' ELSE 'part' END AS kind FROM documents)"""
)
def page_render(spark, sf_dir):
    """R5 over whole texts."""
    d = table(spark, sf_dir, "documents")
    title = F.concat("source", F.lit(" <"), "doc_id", F.lit(">"))
    return d.select("doc_id", render.xhtml_page(title, X.escape(F.col("text")), "../style.css", F.when(F.col("doc_id") % 2 == 0, "chapter").otherwise("part")).alias("xhtml"))


@query(
    f"""SELECT book_id, '<dc:identifier id="pub-id">urn:x:' || book_id || '</dc:identifier>' || chr(10) || '<dc:title>t&amp;' || book_id || '</dc:title>' || chr(10) || '<dc:language>ja</dc:language>' || chr(10)
    || CASE WHEN book_id % 2 = 0 THEN '<dc:creator>a' || book_id || '</dc:creator>' || chr(10) ELSE '' END || '<dc:publisher>p</dc:publisher>' || chr(10) || '<meta property="dcterms:modified">2000-01-01T00:00:00Z</meta>' || chr(10)
    || '<meta name="primary-writing-mode" content="vertical-rl"/>' || chr(10) || '</metadata>' || chr(10) || '<manifest>' || chr(10) || items || chr(10) || '</manifest>' || chr(10) || '<spine toc="ncx" page-progression-direction="rtl">' || chr(10) || refs || chr(10) || '</spine>' || chr(10) || '</package>' || chr(10) AS opf
    FROM (SELECT book_id, string_agg('<item id="c' || id || '" href="text/' || id || '.xhtml" media-type="application/xhtml+xml"' || CASE WHEN id % 2 = 1 THEN ' properties="svg"' ELSE '' END || '/>', chr(10) ORDER BY id) AS items,
    string_agg('<itemref idref="c' || id || '"' || CASE WHEN id % 3 = 0 THEN ' linear="no"' ELSE '' END || '/>', chr(10) ORDER BY id) AS refs FROM (SELECT DISTINCT o_custkey AS book_id, o_orderkey AS id FROM orders) GROUP BY 1)"""
)
def package_render(spark, sf_dir):
    """The package document from its identifier on; orders of a customer as its files."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("book_id"), F.col("o_orderkey").alias("pos")).distinct()
    id_ = F.concat(F.lit("c"), "pos")
    manifest = o.select("book_id", "pos", id_.alias("id"), F.concat(F.lit("text/"), "pos", F.lit(".xhtml")).alias("href"), F.lit("application/xhtml+xml").alias("media_type"), F.when(F.col("pos") % 2 == 1, "svg").alias("properties"))
    spine = o.select("book_id", "pos", id_.alias("idref"), F.when(F.col("pos") % 3 == 0, "no").alias("linear"))
    b = F.col("book_id")
    books = o.select("book_id").distinct().select(b, F.concat(F.lit("t&"), b).alias("title"), F.when(b % 2 == 0, F.concat(F.lit("a"), b)).alias("author"), F.lit("p").alias("publisher"), F.concat(F.lit("urn:x:"), b).alias("identifier"), F.lit("2000-01-01T00:00:00Z").alias("modified"))
    mark = "<dc:identifier"
    return render.opf(books, manifest, spine).select("book_id", F.concat(F.lit(mark), F.substring_index("opf", mark, -1)).alias("opf"))
