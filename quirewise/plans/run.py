
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import checks, render, structure
from ..sources import sinks
from ..sources.scratch import written
from . import blocks as block_plan


def build_package(blocks: DataFrame, nav: DataFrame, books: DataFrame, horizontal: bool = False) -> tuple[DataFrame, DataFrame]:
    """(packages, problems): chapters, navigation, NCX, style sheet and package document of each book, zipped and
    checked. books: book_id, title, author, publisher, identifier, modified, first_href."""
    chapters = render.chapters_xhtml(blocks, not horizontal)
    files = chapters.select("book_id", F.concat(F.lit("text/"), "file").alias("href"), F.col("xhtml").alias("body"), F.col("chapter_no").alias("n"))
    fixed = lambda href, df, body, n: df.select("book_id", F.lit(href).alias("href"), body.alias("body"), F.lit(n).alias("n"))
    files = files.unionByName(fixed("style.css", books, F.lit(render.css(horizontal)), -3)).unionByName(fixed("nav.xhtml", render.nav_xhtml(nav, books, not horizontal), F.col("xhtml"), -2))
    files = files.unionByName(fixed("toc.ncx", render.ncx(structure.play_order(nav), books), F.col("ncx"), -1))
    id_ = F.when(F.col("href") == "toc.ncx", "ncx").otherwise(F.regexp_replace("href", r"[/.]", "-"))
    kind = F.when(F.col("href") == "style.css", "text/css").when(F.col("href") == "toc.ncx", checks.NCX_TYPE).otherwise("application/xhtml+xml")
    manifest = files.select("book_id", F.col("n").alias("pos"), id_.alias("id"), "href", kind.alias("media_type"), F.when(F.col("href") == "nav.xhtml", "nav").alias("properties"))
    spine = manifest.where("pos >= 0").select("book_id", "pos", F.col("id").alias("idref"), F.lit(None).cast("string").alias("linear"))
    package = render.opf(books, manifest, spine, horizontal).select("book_id", F.lit("package.opf").alias("href"), F.col("opf").alias("body"), F.lit(-4).alias("n"))
    entries = files.unionByName(package).select("book_id", F.col("n").alias("pos"), F.concat(F.lit("OEBPS/"), "href").alias("name"), F.encode("body", "UTF-8").alias("bytes"))
    packages = written(render.zip_books(entries), "packages")  # the checks read it many times
    return packages, checks.self_check(written(render.read_zips(packages), "entries"), horizontal)


def publish_books(pages: DataFrame, layer: DataFrame, books: DataFrame, folder: str, layout: DataFrame | None = None, skip: DataFrame | None = None, contents_pages: DataFrame | None = None, horizontal: bool = False) -> DataFrame:
    """O1: pages to blocks, without the printed contents, to chapters, to book_id.epub and book_id.txt in folder; returns
    what the checks found. Books with problems are written too, as the caller decides on them. A null or empty author or
    publisher is left out; a book without blocks has no files.

    pages, layer, layout, skip: as of blocks.build_blocks; contents_pages: (book_id, page) of printed contents; books:
    book_id, title, author, publisher, identifier, modified.
    """
    blocks = block_plan.build_blocks(pages, layer, layout, skip)[0]
    blocks = written(block_plan.without_printed_contents(blocks, contents_pages=contents_pages), "blocks")
    chapters, nav = structure.split_chapters(blocks)
    chapters, nav = written(chapters, "chapters"), written(nav, "nav")
    known = books.join(chapters.groupBy("book_id").agg(F.concat(F.lit("text/"), F.min("file")).alias("first_href")), "book_id")
    packages, problems = build_package(chapters, nav, known, horizontal)
    sinks.write_packages(packages, folder)
    sinks.write_texts(render.plain_text(blocks, "figures"), folder)
    return problems
