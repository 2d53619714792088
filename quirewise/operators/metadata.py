
from __future__ import annotations

import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X

FIELDS = ("isbn", "title", "author", "publisher", "series", "pubdate", "extent", "source", "link")
OPENBD = """struct<onix:struct<DescriptiveDetail:struct<Contributor:array<struct<PersonName:struct<content:string>>>>>,
summary:struct<isbn:string,title:string,series:string,publisher:string,pubdate:string,author:string>>"""
# Sources by name, the record link, what counts as a book, roles behind names, labels.
FIRST_SOURCE, SECOND_SOURCE, RECORD_LINK = "openBD", "NDLサーチ", "https://api.openbd.jp/v1/get?isbn="
BOOK_CATEGORIES = ("図書",)
ROLES = ("著述", "編著", "共著", "監修", "編集", "著", "編", "訳", "撰", "画")
LABELS = (("書名", "title"), ("著者", "author"), ("出版社", "publisher"), ("シリーズ", "series"), ("刊行", "pubdate"), ("ページ数", "extent"), ("ISBN", "isbn"))
LIFE = r"[,、]?[\s　]*\d{3,4}[\s　]*[-–—~〜][\s　]*\d{0,4}[\s　]*"
JAPANESE = "[ぁ-んァ-ヶ一-龥]"


def digits(s: Column) -> Column:
    return F.transform(F.split(s, ""), lambda c: c.try_cast("int"))


def check_digit_13(body: Column) -> Column:
    """Of 12 digits."""
    total = F.aggregate(F.transform(digits(body), lambda d, i: d * F.when(i % 2 == 1, 3).otherwise(1)), F.lit(0), lambda a, x: a + x)
    return ((10 - total % 10) % 10).cast("string")


def check_digit_10(body: Column) -> Column:
    """Of 9 digits; ten is X."""
    total = F.aggregate(F.transform(digits(body), lambda d, i: d * (10 - i)), F.lit(0), lambda a, x: a + x)
    rest = (11 - total % 11) % 11
    return F.when(rest == 10, "X").otherwise(rest.cast("string"))


def normalize_isbn(raw: Column) -> Column:
    """13 digits, null if it is no ISBN or its check digit is wrong."""
    s = F.regexp_replace(F.upper(F.regexp_replace(raw, r"(?U)[\s　\-‐‑–—―ー]", "")), "^ISBN", "")
    ten, thirteen = s.rlike(r"^\d{9}[\dX]$"), s.rlike(r"^\d{13}$")
    body = F.concat(F.lit("978"), F.substring(s, 1, 9))
    old = F.when(ten & (F.substring(s, 10, 1) == check_digit_10(F.when(ten, F.substring(s, 1, 9)))), F.concat(body, check_digit_13(F.when(ten, body))))
    new = F.when(F.substring(s, 13, 1) == check_digit_13(F.when(thirteen, F.substring(s, 1, 12))), s)
    return F.when(ten, old).when(thirteen, new)


def clean_author(raw: Column) -> Column:
    """Without life dates and roles at the end; Japanese names are closed up, others get blanks for commas."""
    s = X.strip(F.coalesce(raw, F.lit("")))
    ends = "(?:" + LIFE + r"|[\s　]*(?:" + "|".join(ROLES) + r")[\s　]*)+\z"
    s = X.strip(F.regexp_replace(s, ends, ""))
    japanese = F.regexp_replace(s, r"[\s　]*[,、][\s　]*", "")
    return X.strip(F.when(s.rlike(JAPANESE), japanese).otherwise(F.regexp_replace(s, r"\s*,\s*", " ")))


def join_authors(names: Column) -> Column:
    """T23."""
    return F.array_join(F.array_distinct(F.filter(F.transform(names, clean_author), lambda n: n != "")), "、")


def format_pubdate(raw: Column) -> Column:
    """Year and month as 1996.3."""
    s = F.regexp_replace(F.coalesce(raw, F.lit("")), r"\D", "")
    month = F.concat(F.substring(s, 1, 4), F.lit("."), F.substring(s, 5, 2).try_cast("int").cast("string"))
    return F.when(F.length(s) >= 6, month).when(F.length(s) == 4, s).otherwise(X.strip(F.coalesce(raw, F.lit(""))))


def parse_openbd(record: Column) -> Column:
    """M1: struct of FIELDS of a record (OPENBD), null without a title."""
    text = lambda c: X.strip(F.coalesce(record[f"summary"][c], F.lit("")))
    names = F.transform(record["onix"]["DescriptiveDetail"]["Contributor"], lambda c: F.coalesce(c["PersonName"]["content"], F.lit("")))
    author = join_authors(F.coalesce(names, F.array().cast("array<string>")))
    isbn = F.coalesce(normalize_isbn(record["summary"]["isbn"]), F.lit(""))
    values = {
        "isbn": isbn, "title": text("title"), "author": F.when(author != "", author).otherwise(clean_author(record["summary"]["author"])),
        "publisher": text("publisher"), "series": text("series"), "pubdate": format_pubdate(record["summary"]["pubdate"]),
        "source": F.lit(FIRST_SOURCE), "link": F.when(isbn != "", F.concat(F.lit(RECORD_LINK), isbn)).otherwise(F.lit("")),
    }
    return F.when(text("title") != "", F.struct(*(values.get(f, F.lit("")).alias(f) for f in FIELDS)))


ITEM = "array<struct<title:string,link:string,publisher:string,seriesTitle:string,issued:string,date:string,extent:string,category:array<string>,creator:array<string>,identifier:array<string>>>"


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in ("title", "link", "publisher", "seriesTitle", "issued", "date", "extent")] + [T.StructField(c, T.ArrayType(T.StringType())) for c in ("category", "creator", "identifier")])))
def feed_items(xml: pd.Series) -> pd.Series:
    """The items of a feed whatever its namespaces; broken XML has none."""
    ones, lists = ("title", "link", "publisher", "seriesTitle", "issued", "date", "extent"), ("category", "creator", "identifier")

    def items(source) -> list[dict]:
        try:
            root = ET.fromstring(source)
        except (ET.ParseError, TypeError):
            return []
        out = []
        for item in root.iter():
            if item.tag.rpartition("}")[2] == "item":
                found: dict[str, list[str]] = {}
                for child in item:
                    if value := (child.text or "").strip():
                        found.setdefault(child.tag.rpartition("}")[2], []).append(value)
                out.append({c: found.get(c, [""])[0] for c in ones} | {c: found.get(c, []) for c in lists})
        return out

    return xml.map(items)


def parse_items(feeds: DataFrame, keys: list[str], xml: str = "xml", books_only: bool = True) -> DataFrame:
    """M2: (keys, pos, FIELDS) of the books of feeds; of those with one ISBN, else link, else title, the first."""
    i = feeds.select(*keys, F.posexplode(feed_items(xml)).alias("pos", "i")).where("i.title <> ''")
    if books_only:
        i = i.where(F.arrays_overlap("i.category", F.array(*map(F.lit, BOOK_CATEGORIES))))
    isbn = F.coalesce(F.get(F.filter(F.transform("i.identifier", normalize_isbn), lambda x: x.isNotNull()), F.lit(0)), F.lit(""))
    i = i.select(
        *keys, "pos", isbn.alias("isbn"), "i.title", join_authors(F.col("i.creator")).alias("author"), "i.publisher", F.col("i.seriesTitle").alias("series"),
        F.when(F.col("i.issued") != "", F.col("i.issued")).otherwise(F.col("i.date")).alias("pubdate"), "i.extent", F.lit(SECOND_SOURCE).alias("source"), "i.link",
    )
    return first_wins(i, keys, F.when(F.col("isbn") != "", F.col("isbn")).when(F.col("link") != "", F.col("link")).otherwise(F.col("title")), "pos")


def first_wins(rows: DataFrame, keys: list[str], key: Column, order: str) -> DataFrame:
    """M2: of rows with one key the first in order."""
    k = F.row_number().over(Window.partitionBy(*keys, "_key").orderBy(order))
    return rows.withColumn("_key", key).withColumn("_k", k).where("_k = 1").drop("_key", "_k")


def pick_exact(items: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """M3: of wanted(keys, isbn13) the first item with just this ISBN."""
    hits = items.join(wanted, keys).where("isbn = isbn13")
    return hits.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy("pos"))).where("_k = 1").drop("_k", "pos")


def lookup(requests: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """M4: requests(request, isbn) with FIELDS from the first source, else the second; null where there is none.

    first: request, record (OPENBD); second: request, xml.
    """
    wanted = requests.select("request", normalize_isbn(F.col("isbn")).alias("isbn13")).where("isbn13 is not null")
    a = first.select("request", parse_openbd(F.col("record")).alias("a"))
    b = pick_exact(parse_items(second, ["request"]), wanted, ["request"]).select("request", F.struct(*FIELDS).alias("b"))
    found = wanted.join(a, "request", "left").join(b, "request", "left")
    return found.select("request", "isbn13", F.coalesce("a", "b").alias("meta")).select("request", "isbn13", "meta.*")


def search(items: DataFrame, keys: list[str], limit: int = 10) -> DataFrame:
    """M5: the first `limit` items of each request."""
    return items.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy("pos"))).where(F.col("_k") <= limit).drop("_k")


def fill_blanks(given: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """M6: what is given wins; blanks are filled from what was found."""
    f = found.select(key, *(F.col(c).alias(f"_{c}") for c in FIELDS if c in found.columns))
    j = given.join(f, key, "left")
    return j.select(key, *(F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(f"_{c}"), F.lit("")).alias(c) for c in FIELDS if c in given.columns and c in found.columns))


def summary_lines() -> Column:
    """M7: labelled lines of the fields that aren't empty."""
    return F.filter(F.array(*(F.when(F.col(c) != "", F.concat(F.lit(f"{label}: "), F.col(c))) for label, c in LABELS)), lambda x: x.isNotNull())
