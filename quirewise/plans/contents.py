
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as X

# Places tried for the page offset, and the title of what stands before the first chapter.
PROBES, FRONT_MATTER = 60, "前付"


def assert_none(rejects: DataFrame, what: str) -> None:
    """Raises if there are rejects, naming some."""
    some = rejects.limit(5).collect()
    if some:
        raise ValueError(f"{what}: {[r.asDict() for r in some]}")


def is_front_back(title: Column) -> Column:
    """C4 of a normalized title."""
    words = [w for w in P.FRONT_BACK if w not in P.CONTENTS]
    return title.rlike(P.front_back(words)) | title.rlike(P.UNNUMBERED_TOC_RE)


def parse_row(row: Column) -> Column:
    """struct(level, title, page_num, is_roman) of a contents row, null if it is no entry."""
    r = X.strip(row)
    part = r.rlike(P.TOC_PART_RE)
    entry = part | r.rlike(P.TOC_CHAPTER_RE) | r.rlike(P.COLUMN_RE) | is_front_back(r)
    digits = F.regexp_extract(r, r"(\d+)\s*$", 1)
    roman = F.regexp_extract(r, r"([ivxlcIVXLC]{1,6})\s*$", 1)
    number = F.when(digits != "", digits.try_cast("int")).when(roman != "", X.roman_to_int(roman))
    title = X.strip(F.when(digits != "", F.regexp_replace(r, r"\d+\s*$", "")).when(roman != "", F.regexp_replace(r, r"[ivxlcIVXLC]{1,6}\s*$", "")).otherwise(r))
    fields = F.struct(
        F.when(part, "部").otherwise("大").alias("level"), F.when(title == "", r).otherwise(title).alias("title"),
        number.alias("page_num"), ((digits == "") & (roman != "")).alias("is_roman"),
    )
    return F.when(entry & (r != ""), fields)


def entries(rows: DataFrame) -> DataFrame:
    """Contents entries of rows(book_id, page, row, row_text), in order as `ord`.

    Numbers that stand in rows of their own go to the entries that wait for one, oldest first; a number that comes while
    none waits is lost. That is a fold over a book's contents pages, which are few, so it is one aggregate() a book.
    """
    r = rows.withColumn("_e", parse_row(F.col("row_text")))
    only = F.array_sort(F.transform(F.regexp_extract_all("row_text", F.lit(r"\d+"), 0), lambda x: x.try_cast("int")))
    last = F.regexp_extract("row_text", r"(\d+)\s*$", 1)
    none = F.array().cast("array<int>")
    supply = F.when(F.col("row_text").rlike(r"^[\d\s]+$"), only).when(last != "", F.array(last.try_cast("int"))).otherwise(none)
    item = F.struct("page", "row", F.col("_e").alias("e"), F.when(F.col("_e").isNull(), supply).otherwise(none).alias("nums"))
    book = r.groupBy("book_id").agg(F.array_sort(F.collect_list(item)).alias("items"))
    waits = F.filter(F.sequence(F.lit(0), F.size("items") - 1), lambda i: F.get("items", i)["e"].isNotNull() & F.get("items", i)["e"]["page_num"].isNull())

    def step(state: Column, i: Column) -> Column:
        # Entries that wait before place i and aren't served yet, by how many were served.
        open_ = F.size(F.filter(waits, lambda w: w < i)) - F.size(state)
        take = F.slice(F.get("items", i)["nums"], F.lit(1), F.greatest(open_, F.lit(0)))
        return F.concat(state, take)

    served = F.aggregate(F.sequence(F.lit(0), F.size("items") - 1), none, step)
    book = book.withColumn("_served", served).withColumn("_waits", waits)
    place = F.posexplode("items").alias("_i", "x")
    flat = book.select("book_id", "_served", "_waits", place).where("x.e is not null")
    turn = F.array_position("_waits", F.col("_i"))
    given = F.when(turn > 0, F.get("_served", (turn - 1).cast("int")))
    flat = flat.select("book_id", "_i", "x.e.level", "x.e.title", F.coalesce(given, F.col("x.e.page_num")).alias("page_num"), (F.col("x.e.is_roman") & given.isNull()).alias("is_roman"))
    return flat.withColumn("ord", F.row_number().over(Window.partitionBy("book_id").orderBy("_i"))).drop("_i")


def fix_entries(toc: DataFrame, fixes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Page numbers by hand; fixes has book_id, key, value (text). A key must start exactly one title; others are rejects."""
    flat = lambda c: F.replace(X.normalize(c), F.lit(" "), F.lit(""))
    t = toc.select("book_id", "ord", flat(F.col("title")).alias("_t"))
    f = fixes.withColumn("_n", F.monotonically_increasing_id()).withColumn("_k", flat(F.col("key")))
    hits = f.join(t, (f.book_id == t.book_id) & t["_t"].startswith(f["_k"]), "left").groupBy(f["_n"], f["book_id"], f["key"], f["value"]).agg(F.count("ord").alias("hits"), F.max("ord").alias("ord"))
    good = (F.col("hits") == 1) & (X.strip(F.col("key")) != "") & F.col("value").rlike(r"^\s*\d+\s*$")
    rejects = hits.where(~F.coalesce(good, F.lit(False))).select("book_id", "key", "value", "hits")
    last = hits.where(good).groupBy("book_id", "ord").agg(F.max_by(X.strip(F.col("value")).cast("int"), "_n").alias("_page"))
    out = toc.join(last, ["book_id", "ord"], "left").withColumn("is_roman", F.col("is_roman") & F.col("_page").isNull())
    return out.withColumn("page_num", F.coalesce("_page", "page_num")).drop("_page"), rejects


def needle(title: Column) -> Column:
    """What of a title is looked for in pages, before normalization; '' if too little is left."""
    t = F.regexp_replace(title, r"(?i)^第\s*[0-9０-９IVXⅠ-Ⅴ]{1,4}\s*[部章]|^Column\s*\d+", "")
    t = F.regexp_replace(F.regexp_replace(t, r"(\d+)\s*$", ""), r"^[0-9０-９\s]+", "")
    return F.regexp_extract(t, rf"^[^\s{P.DASHES}]+", 0)


def offset(toc: DataFrame, pages: DataFrame, contents: DataFrame, n_pages: DataFrame, probes: int = PROBES) -> DataFrame:
    """(book_id, target_page, needle, offset) - the first of `probes` offsets at which the target entry's page has its
    title; offset is null if none does. pages: book_id, page, text (normalized); contents: pages to pass over."""
    e = toc.where("page_num is not null and not is_roman").withColumn("_fb", is_front_back(X.normalize(F.col("title"))))
    order = Window.partitionBy("book_id").orderBy("_fb", "page_num", "ord")
    target = e.withColumn("_k", F.row_number().over(order)).where("_k = 1").withColumn("needle", X.normalize(needle(F.col("title"))))
    target = target.select("book_id", F.col("page_num").alias("target_page"), F.when(F.length("needle") >= 2, F.col("needle")).alias("needle"))
    tried = target.select("*", F.explode(F.sequence(F.lit(0), F.lit(probes - 1))).alias("_o")).withColumn("page", F.col("target_page") + F.col("_o"))
    tried = tried.join(n_pages, "book_id").where("page between 1 and n_pages").join(contents, ["book_id", "page"], "left_anti")
    hit = tried.join(pages, ["book_id", "page"]).where(F.col("text").contains(F.col("needle"))).groupBy("book_id").agg(F.min("_o").alias("offset"))
    return target.join(hit, "book_id", "left")


def chapter_plan(toc: DataFrame, offsets: DataFrame, n_pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(plan, rejects). Rejects have a reason: `order` (page numbers that don't rise) or `range` (left out of the plan).
    A book with an `order` reject is refused: it has no plan, and only those rejects.

    toc: book_id, ord, level, title, page_num, is_roman; offsets: book_id, offset; n_pages: book_id, n_pages.
    """
    order = Window.partitionBy("book_id").orderBy("ord")
    e = toc.where("page_num is not null and not is_roman").join(offsets.select("book_id", "offset"), "book_id").join(n_pages, "book_id")
    e = e.withColumn("_prev", F.lag("page_num").over(order)).withColumn("_next", F.lead("page_num").over(order))
    e = e.withColumn("start", F.col("page_num") + F.col("offset"))
    e = e.withColumn("end", F.least(F.coalesce(F.col("_next") + F.col("offset") - 1, F.col("n_pages")), F.col("n_pages")))
    fits = "start between 1 and n_pages and start <= end"
    falls = F.coalesce(F.col("page_num") <= F.col("_prev"), F.lit(False))
    e = e.withColumn("_falls", falls).withColumn("_refused", F.max("_falls").over(Window.partitionBy("book_id")))
    reason = F.when(F.col("_falls"), "order").when(~F.col("_refused") & ~F.expr(fits), "range")
    rejects = e.withColumn("reason", reason).where("reason is not null").select("book_id", "ord", "title", "page_num", "start", "end", "reason")
    return e.where(~F.col("_refused") & F.expr(fits)).select("book_id", "ord", "title", "level", "start", "end"), rejects


def uncovered_pages(plan: DataFrame, n_pages: DataFrame, leave_out: DataFrame) -> DataFrame:
    """(book_id, page) in no chapter's range and not in leave_out(book_id, page)."""
    pages = n_pages.where("n_pages >= 1").select("book_id", F.explode(F.sequence(F.lit(1), "n_pages")).alias("page"))
    covered = plan.where("start <= end").select("book_id", F.explode(F.sequence("start", "end")).alias("page"))
    return pages.join(leave_out.select("book_id", "page"), ["book_id", "page"], "left_anti").join(covered, ["book_id", "page"], "left_anti")


def cover_front(plan: DataFrame, uncovered: DataFrame) -> DataFrame:
    """The plan with a chapter for what is uncovered before its first one, or for all if it has none."""
    first = plan.groupBy("book_id").agg(F.min_by("start", "ord").alias("_first"), F.min("ord").alias("_ord"))
    head = uncovered.join(first, "book_id", "left").where("_first is null or page < _first")
    front = head.groupBy("book_id", "_first", "_ord").agg(F.min("page").alias("start"), F.max("page").alias("_last"))
    front = front.select("book_id", F.coalesce(F.col("_ord") - 1, F.lit(0)).alias("ord"), F.lit(FRONT_MATTER).alias("title"), F.lit("大").alias("level"), "start", F.coalesce(F.col("_first") - 1, F.col("_last")).alias("end"))
    return plan.unionByName(front)
