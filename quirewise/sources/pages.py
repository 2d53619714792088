
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CELL = "struct<row:int,col:int,row_span:int,col_span:int,contents:string>"
PAGE_SCHEMA = f"""page int, image_size struct<h:int,w:int>,
words array<struct<points:array<array<double>>,content:string,direction:string>>,
paragraphs array<struct<box:array<double>,contents:string,direction:string,order:int,role:string>>,
tables array<struct<box:array<double>,n_row:int,n_col:int,order:int,cells:array<{CELL}>>>,
figures array<struct<box:array<double>,order:int,paragraphs:array<struct<contents:string>>>>"""
FIX_SCHEMA = "page int, before string, after string, why string"


def read_pages(spark: SparkSession, path: str, book_id: str | Column) -> DataFrame:
    """Page files p*.json of a book; a broken file fails the read and is named, an empty folder has no rows to plan."""
    pages = spark.read.schema(PAGE_SCHEMA).option("multiLine", True).option("mode", "FAILFAST").option("pathGlobFilter", "p*.json").json(path)
    return pages.select((F.lit(book_id) if isinstance(book_id, str) else book_id).alias("book_id"), *pages.columns)


def missing_pages(spark: SparkSession, wanted: tuple[int | None, int | None], n_pages: int, have: DataFrame, overwrite: bool = False) -> DataFrame:
    """Pages of the wanted range, kept within the book, that aren't in have(page) yet."""
    first, last = max(1, wanted[0] or 1), min(n_pages, wanted[1] or n_pages)
    pages = spark.range(first, last + 1).select(F.col("id").cast("int").alias("page"))
    return pages if overwrite else pages.join(have.select("page"), "page", "left_anti")


def page_cache(requested: DataFrame, have: DataFrame, provider, schema: str) -> DataFrame:
    """Pages read where they exist, else made by provider(iterator of record batches) -> such; keys book_id, page."""
    keys = ["book_id", "page"]
    known = have.join(requested.select(*keys), keys, "left_semi")
    made = requested.select(*keys).join(have.select(*keys), keys, "left_anti").mapInArrow(provider, schema)
    return known.unionByName(made)


def text_layer(extracted: DataFrame) -> DataFrame:
    """(book_id, page, layer) of extracted(book_id, text): pages are parted by form feeds; a null text has none."""
    pages = extracted.where("text is not null").select("book_id", F.posexplode(F.split("text", "\f", -1)).alias("_n", "layer"))
    return pages.select("book_id", (F.col("_n") + 1).alias("page"), "layer")


def read_fixes(spark: SparkSession, path: str, book_id: str) -> DataFrame:
    """A JSON array of fixes, in order."""
    raw = spark.read.text(path, wholetext=True)
    kind = f"array<struct<{', '.join(f.strip().replace(' ', ':', 1) for f in FIX_SCHEMA.split(','))}>>"
    fixes = raw.select(F.posexplode(F.from_json("value", kind, {"mode": "FAILFAST"})).alias("ord", "f"))
    return fixes.select(F.lit(book_id).alias("book_id"), "ord", "f.*")


def explode_lines(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, line_no from 1, line) of whole texts; blank lines stay."""
    return texts.select(key, F.posexplode(F.split(text, "\n", -1)).alias("_n", "line")).select(key, (F.col("_n") + 1).alias("line_no"), "line")


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of whole files with their file."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))
    return explode_lines(files, "file")
