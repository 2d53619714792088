
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as X

UNTITLED = "（無題）"


def by_seq(*more: str) -> Window:
    return Window.partitionBy("book_id", *more).orderBy("seq")


def so_far(order):
    return order.rowsBetween(Window.unboundedPreceding, 0)


def page_chars(blocks: DataFrame) -> DataFrame:
    """H1: (book_id, page, chars) of the raw lines of paragraphs."""
    size = F.aggregate("lines", F.lit(0), lambda n, l: n + F.length(l))
    return blocks.where("kind = 'para' and page is not null").groupBy("book_id", "page").agg(F.sum(size).alias("chars"))


def demote_part_headings(blocks: DataFrame, title: Column | None = None, part: str = P.PART_RE, limit: int = P.TITLE_PAGE_CHARS) -> DataFrame:
    """H2: part headings on pages full of text become paragraphs, if the book has real title pages of parts.

    If each title page has a number of its own, only headings of such a number are compared; else all of the book's.
    """
    b = blocks.withColumn("_title", F.when((F.col("kind") == "heading") & (F.col("level") == "大"), title if title is not None else X.heading_title(F.col("lines"))))
    b = b.withColumn("_num", F.regexp_extract("_title", part, 0)).withColumn("_num", F.when(F.col("page").isNotNull() & (F.col("_num") != ""), F.col("_num")))
    heads = b.where("_num is not null").select("book_id", "seq", "page", "_num").join(page_chars(blocks), ["book_id", "page"], "left").withColumn("_light", F.coalesce("chars", F.lit(0)) <= limit)
    books = heads.groupBy("book_id").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("_light"), 1)).alias("light"), F.count_distinct(F.when(F.col("_light"), F.col("_num"))).alias("nums"),
    ).where("n >= 2 and light >= 1")
    numbers = heads.where("_light").select("book_id", "_num").distinct().withColumn("_known", F.lit(True))
    heavy = heads.where("not _light").join(books, "book_id").join(numbers, ["book_id", "_num"], "left")
    gone = heavy.where("nums <> light or _known").select("book_id", "seq").withColumn("_gone", F.lit(True))
    b = b.drop("_title", "_num").join(gone, ["book_id", "seq"], "left")
    kind = F.when(F.col("_gone"), "para").otherwise(F.col("kind"))
    return b.withColumn("level", F.when(F.col("_gone").isNull(), F.col("level"))).withColumn("kind", kind).drop("_gone")


def split_chapters(blocks: DataFrame, title: Column | None = None, part: str = P.PART_RE, top: str = P.TOP_LEVEL_BACK_RE) -> tuple[DataFrame, DataFrame]:
    """H3: blocks with chapter_no (from 0), file, section_type and id, and the navigation tree as rows.

    A large heading starts a chapter unless it repeats the title of the large heading before; a repeated one goes. What
    comes before the first is a chapter of its own. nav: book_id, node_id (pre-order), parent_id, depth, title, href, seq.
    """
    order = by_seq()
    b = blocks.withColumn("_large", F.coalesce((F.col("kind") == "heading") & (F.col("level") == "大"), F.lit(False)))
    b = b.withColumn("_title", F.when(F.col("kind") == "heading", title if title is not None else X.heading_title(F.col("lines"))))
    large = F.when(F.col("_large"), F.col("_title"))
    before = F.last(large, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    b = b.withColumn("_again", F.coalesce(F.col("_large") & (F.col("_title") != "") & (F.col("_title") == before), F.lit(False))).where("not _again")
    starts = F.col("_large") | (F.row_number().over(order) == 1)
    b = b.withColumn("_starts", starts.cast("int")).withColumn("chapter_no", F.sum("_starts").over(so_far(order)) - 1)
    b = b.withColumn("file", F.format_string("ch%03d.xhtml", "chapter_no"))
    b = b.withColumn("_part", F.col("_large") & F.col("_title").rlike(part))
    b = b.withColumn("section_type", F.when(F.first("_part").over(Window.partitionBy("book_id", "chapter_no").orderBy("seq")), "part").otherwise("chapter"))
    small = F.coalesce((F.col("kind") == "heading") & F.col("level").isin("中", "小"), F.lit(False))
    b = b.withColumn("_small", small).withColumn("_n", F.sum(F.col("_small").cast("int")).over(so_far(order)))
    b = b.withColumn("id", F.when(F.col("_small"), F.format_string("h%04d", "_n")))
    # The part that a block is in and the heading that a middle one belongs to, both by their place in the book.
    b = b.withColumn("_in_part", F.last(F.when(F.col("_part"), F.col("seq")), ignorenulls=True).over(so_far(order)))
    b = b.withColumn("_in_large", F.last(F.when(F.col("_large"), F.col("seq")), ignorenulls=True).over(so_far(order)))
    top_level = F.col("_part") | F.col("_title").rlike(top) | F.col("_in_part").isNull()
    nodes = b.where(F.col("_large") | (F.col("_small") & (F.col("level") == "中") & F.col("_in_large").isNotNull()))
    parent = F.when(F.col("_large"), F.when(~top_level, F.col("_in_part"))).otherwise(F.col("_in_large"))
    href = F.concat(F.lit("text/"), "file", F.when(F.col("_large"), F.lit("")).otherwise(F.concat(F.lit("#"), "id")))
    nodes = nodes.select("book_id", "seq", parent.alias("_parent"), F.when(F.col("_title") == "", UNTITLED).otherwise(F.col("_title")).alias("title"), href.alias("href"))
    up = nodes.select("book_id", F.col("seq").alias("_parent"), F.col("_parent").alias("_grand"))
    nodes = nodes.join(up, ["book_id", "_parent"], "left")
    path = F.filter(F.array("_grand", "_parent", "seq"), lambda x: x.isNotNull())
    # Pre-order: a node's children follow it before its next sibling, as paths of places in the book are compared.
    nodes = nodes.withColumn("_path", path).withColumn("node_id", F.row_number().over(Window.partitionBy("book_id").orderBy("_path")))
    ids = nodes.select("book_id", F.col("seq").alias("_parent"), F.col("node_id").alias("parent_id"))
    nav = nodes.join(ids, ["book_id", "_parent"], "left").select("book_id", "node_id", "parent_id", F.size("_path").alias("depth"), "title", "href", "seq")
    return b.drop("_large", "_title", "_again", "_starts", "_part", "_small", "_n", "_in_part", "_in_large"), nav


def chapters_without_entry(blocks: DataFrame) -> DataFrame:
    """H4-H5: chapters that don't start with a large heading, and their pages."""
    first = blocks.groupBy("book_id", "chapter_no").agg(
        F.min_by(F.coalesce((F.col("kind") == "heading") & (F.col("level") == "大"), F.lit(False)), "seq").alias("_head"), F.min("page").alias("lo"), F.max("page").alias("hi"),
    )
    return first.where("not _head").select("book_id", "chapter_no", chapter_pages(F.col("lo"), F.col("hi")).alias("pages"))


def chapter_pages(low: Column, high: Column) -> Column:
    """H5."""
    return F.when(low.isNull(), "?").when(low == high, F.concat(F.lit("p"), low)).otherwise(F.concat(F.lit("p"), low, F.lit("〜p"), high))


def nav_depth(nav: DataFrame) -> DataFrame:
    """H6: (book_id, depth)."""
    return nav.groupBy("book_id").agg(F.max("depth").alias("depth"))


def play_order(nav: DataFrame) -> DataFrame:
    """H7: nav with play_order, one for each target in order of first appearance."""
    first = F.min("node_id").over(Window.partitionBy("book_id", "href"))
    return nav.withColumn("_first", first).withColumn("play_order", F.dense_rank().over(Window.partitionBy("book_id").orderBy("_first"))).drop("_first")


def nav_order_problems(nav: DataFrame, spine: DataFrame) -> DataFrame:
    """H8: entries whose file stands before that of the entry before; spine: book_id, href, pos. Fragments and files that
    aren't in the spine don't count."""
    n = nav.withColumn("target", F.split("href", "#", 2)[0]).where("target <> ''").join(spine.select("book_id", F.col("href").alias("target"), "pos"), ["book_id", "target"])
    order = Window.partitionBy("book_id").orderBy("node_id")
    n = n.withColumn("before", F.lag("pos").over(order)).withColumn("before_target", F.lag("target").over(order))
    return n.where("pos < before").select("book_id", "node_id", "target", "pos", "before_target", "before")
