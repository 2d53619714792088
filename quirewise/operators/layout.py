"""

A page has tens of lines, so each join carries (book_id, page) and stays small; books and pages are the parallelism.
Lines have columns book_id, page, ord (reading rank from 0), x0, x1, y0, y1, h, w, vertical, text.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import patterns as P
from ..functions import text as X

PAGE = ["book_id", "page"]
# Geometry, in medians of the glyph size or shares of the page.
SMALL, GAP_BELOW, GAP_ABOVE, OVERLAP, CHAIN = 0.72, -0.4, 0.9, 0.5, 0.8
GUTTER_FROM, GUTTER_TO, GUTTER_WIDTH, GUTTER_LINES, GUTTER_SIDE = 0.35, 0.65, 0.02, 0.05, 0.2
SAME_ROW, SLACK = 0.4, 2.0


def ranked(order: list[Column], keys: list[str] | None = None) -> Column:
    return F.row_number().over(Window.partitionBy(*(keys or PAGE)).orderBy(*order)) - 1


LINE = ["x0", "x1", "y0", "y1", "vertical", "text", "h", "w"]


def lines_of(words: Column) -> Column:
    """G1 within a page: its word boxes (array of points, content, direction) as lines in order of ord."""

    def box(word: Column, n: Column) -> Column:
        xs, ys = F.transform(word["points"], lambda p: p[0]), F.transform(word["points"], lambda p: p[1])
        ends = F.struct(F.array_min(ys).alias("y0"), F.array_min(xs).alias("x0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))
        vertical = F.coalesce(word["direction"] == "vertical", F.lit(False))
        return X.let(ends, lambda e: F.struct(e["y0"].alias("y0"), e["x0"].alias("x0"), n.alias("n"), e["x1"].alias("x1"), e["y1"].alias("y1"), vertical.alias("vertical"), word["content"].alias("text")))

    def line(b: Column, n: Column) -> Column:
        sizes = {"h": b["y1"] - b["y0"], "w": b["x1"] - b["x0"]}
        return F.struct(*(sizes.get(c, b[c]).alias(c) for c in LINE), n.alias("ord"))

    return F.transform(F.sort_array(F.transform(words, box)), line)


def build_lines(pages: DataFrame) -> DataFrame:
    """G1: boxes of words; pages has book_id, page and words, a page is one row."""
    return pages.select(*PAGE, F.explode(lines_of(F.col("words"))).alias("l")).select(*PAGE, "l.*")


def reading_key(vertical: Column) -> list[Column]:
    """From right to left for vertical text, else from top to bottom; ties keep the order of lines."""
    return [F.when(vertical, -F.col("x0")).otherwise(F.col("y0")), F.when(vertical, F.col("y0")).otherwise(F.col("x0")), F.col("ord")]


def reading_order(lines: DataFrame, vertical: Column | None = None) -> DataFrame:
    """Lines with their rank in reading order as `rank`."""
    return lines.withColumn("rank", ranked(reading_key(vertical if vertical is not None else F.col("vertical"))))


_KANJI = frozenset(chr(c) for c in (*range(0x4E00, 0xA000), ord("々"), ord("〆"), ord("ヵ"), ord("ヶ")))
# Marks that a ruby doesn't stand over at the ends of its base.
_EDGE = frozenset("「」『』（）()〈〉《》、。，．・:：/／ 　")


def base_of(text: str, t0: float, t1: float, r0: float, r1: float, ruby: str) -> tuple[int, int]:
    """Characters of a line that a ruby's extent covers, by their share of the line (wide ones count double)."""
    share = np.array([1.0 if unicodedata.east_asian_width(c) in "WFA" else 0.5 for c in text])
    edges = t0 + np.concatenate([[0.0], np.cumsum(share)]) * ((t1 - t0) / (share.sum() or 1.0))
    inside = np.minimum(r1, edges[1:]) - np.maximum(r0, edges[:-1])
    over = np.flatnonzero(inside > np.diff(edges) * 0.6)
    if not len(over):
        over = [int(np.abs((edges[1:] + edges[:-1]) / 2 - (r0 + r1) / 2).argmin())]
    hiragana = bool(ruby) and all("ぁ" <= c <= "ん" for c in ruby)
    stays = [(c in _KANJI) if hiragana else (c not in _EDGE) for c in text[over[0] : over[-1] + 1]]
    kept = [k for k, s in enumerate(stays) if s]
    if not kept:  # trimming from the front leaves the last character
        return int(over[-1]), int(over[-1]) + 1
    return int(over[0]) + kept[0], int(over[0]) + kept[-1] + 1


@F.pandas_udf(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
def base_span(text: pd.Series, t0: pd.Series, t1: pd.Series, r0: pd.Series, r1: pd.Series, ruby: pd.Series) -> pd.DataFrame:
    """G4 as a column function; widths of characters are in no SQL function."""
    return pd.DataFrame([base_of(*row) for row in zip(text, t0, t1, r0, r1, ruby)], columns=["start", "end"])


def may_change(text: Column) -> Column:
    """Whether attach_ruby() or fix_part_numerals() may change a page that has such a line; they leave others as they are."""
    return F.coalesce(text.rlike(rf"(?U)^[\s{P.RUBY_CHARS}]+\z") | text.rlike(P.PART_TOKEN_RE), F.lit(False))


def ruby_runs(lines: DataFrame) -> DataFrame:
    """G3 up to the base: runs of small kana lines with the line they stand beside.

    Returns book_id, page, vertical, base (ord), base_text, t0, t1, r0, r1, ruby, parts (ords of the run's lines).
    """
    side = Window.partitionBy(*PAGE, "vertical")
    size = F.when(F.col("vertical"), F.col("w")).otherwise(F.col("h"))
    l = lines.withColumn("size", size).withColumn("med", F.median("size").over(side)).withColumn("n", F.count("*").over(side)).where("n >= 3")
    l = l.withColumn("t0", F.when(F.col("vertical"), F.col("y0")).otherwise(F.col("x0"))).withColumn("t1", F.when(F.col("vertical"), F.col("y1")).otherwise(F.col("x1")))
    kana = X.strip(F.replace(F.col("text"), F.lit(" "), F.lit("")))
    small = l.where(F.col("size") < F.col("med") * SMALL).withColumn("ruby", kana).where(F.col("ruby").rlike(rf"^{P.RUBY_TEXT}\z"))
    body = l.where(F.col("size") >= F.col("med") * SMALL)
    r, b = small.alias("r"), body.alias("b")
    gap = F.when(F.col("r.vertical"), F.col("r.x0") - F.col("b.x1")).otherwise(F.col("b.y0") - F.col("r.y1"))
    overlap = F.least("r.t1", "b.t1") - F.greatest("r.t0", "b.t0")
    near = (gap >= F.col("r.med") * GAP_BELOW) & (gap <= F.col("r.med") * GAP_ABOVE) & (overlap >= (F.col("r.t1") - F.col("r.t0")) * OVERLAP)
    same = (F.col("r.book_id") == F.col("b.book_id")) & (F.col("r.page") == F.col("b.page")) & (F.col("r.vertical") == F.col("b.vertical"))
    pairs = r.join(b, same & near).select(
        "r.book_id", "r.page", "r.vertical", "r.med", "r.ruby", F.col("r.ord").alias("part"), F.col("r.t0").alias("f0"), F.col("r.t1").alias("f1"),
        F.col("b.ord").alias("base"), F.col("b.text").alias("base_text"), F.col("b.t0").alias("t0"), F.col("b.t1").alias("t1"),
        F.when(F.col("r.vertical"), -F.col("b.x1")).otherwise(F.col("b.y0")).alias("far"),
    )
    nearest = pairs.withColumn("_k", ranked([F.col("far"), F.col("base")], [*PAGE, "part"])).where("_k = 0 and base_text <> ''")
    order = Window.partitionBy(*PAGE, "base").orderBy("f0", "f1", "ruby", "part")
    reach = F.max("f1").over(order.rowsBetween(Window.unboundedPreceding, -1))
    cut = nearest.withColumn("_new", F.when(F.col("f0") - reach <= F.col("med") * CHAIN, 0).otherwise(1))
    cut = cut.withColumn("run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    part = F.array_sort(F.collect_list(F.struct("f0", "f1", "ruby", "part")))
    runs = cut.groupBy(*PAGE, "vertical", "base", "base_text", "t0", "t1", "run").agg(F.min("f0").alias("r0"), F.max("f1").alias("r1"), part.alias("parts"))
    return runs.withColumn("ruby", F.array_join("parts.ruby", "")).withColumn("parts", F.col("parts.part")).drop("run")


def attach_ruby(lines: DataFrame) -> DataFrame:
    """Ruby lines become marks in the line they stand beside and are taken out."""
    runs = ruby_runs(lines).withColumn("span", base_span("base_text", "t0", "t1", "r0", "r1", "ruby"))
    covered = F.substring(F.col("base_text"), F.col("span.start") + 1, F.col("span.end") - F.col("span.start"))
    runs = runs.where(X.strip(covered) != "")
    edits = runs.groupBy(*PAGE, F.col("base").alias("ord")).agg(F.sort_array(F.collect_list(F.struct("span.start", "span.end", "ruby")), asc=False).alias("edits"))
    gone = runs.select(*PAGE, F.explode("parts").alias("ord"))

    def splice(s: Column, e: Column) -> Column:
        inner = F.substring(s, e["start"] + 1, e["end"] - e["start"])
        return F.concat(F.substring(s, F.lit(1), e["start"]), F.lit("｜"), inner, F.lit("《"), e["ruby"], F.lit("》"), F.substring(s, e["end"] + 1, F.lit(X.MANY)))

    kept = lines.join(gone, [*PAGE, "ord"], "left_anti").join(edits, [*PAGE, "ord"], "left")
    return kept.withColumn("text", F.when(F.col("edits").isNull(), F.col("text")).otherwise(F.aggregate("edits", F.col("text"), splice))).drop("edits")


def fix_part_numerals(lines: DataFrame, layer: DataFrame) -> DataFrame:
    """Part numbers of a page, matched by ordinal with those of its text layer(book_id, page, layer) if as many."""
    hits = F.regexp_extract_all("text", F.lit(P.PART_TOKEN_RE), 1)
    l = lines.withColumn("_hits", hits)
    page = Window.partitionBy(*PAGE)
    l = l.withColumn("_all", F.sum(F.size("_hits")).over(page)).withColumn("_from", F.coalesce(F.sum(F.size("_hits")).over(page.orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    l = l.join(layer.select(*PAGE, F.regexp_extract_all("layer", F.lit(P.PART_TOKEN_RE), 1).alias("_others")), PAGE, "left")
    use = F.coalesce(F.size("_others") == F.col("_all"), F.lit(False))

    def value(token: Column, k: Column) -> Column:
        own = X.roman_value(token)
        other = X.roman_value(F.when(use, F.get("_others", (F.col("_from") + k).cast("int"))))
        chosen = F.when(~F.coalesce(other["sure"], F.lit(False)), own["value"]).when(~own["sure"], other["value"]).otherwise(F.greatest(own["value"], other["value"]))
        return F.when(chosen.between(1, 5), F.concat(F.lit("第"), F.substring(F.lit(P.ROMAN_PARTS), chosen, F.lit(1)), F.lit("部")))

    changed = F.transform("_hits", value)
    text = X.replace_all(F.col("text"), P.PART_TOKEN_RE, lambda m, k: F.coalesce(F.get(changed, k), m))
    return l.withColumn("text", F.when(F.size("_hits") > 0, text).otherwise(F.col("text"))).drop("_hits", "_all", "_from", "_others")


def find_gutter(lines: DataFrame) -> DataFrame:
    """(page keys, split) of the blank band between columns; lines has k0, k1 (extent across columns) and extent.

    Per page the lines over each place are counted by +1 and -1 at their ends, then runs of places with few lines are
    islands; the longest (first of equals) stays if it is wide and parts the lines.
    """
    low, high = (F.col("extent") * GUTTER_FROM).cast("int"), (F.col("extent") * GUTTER_TO).cast("int")
    l = lines.withColumn("_lo", low).withColumn("_hi", high)
    pages = l.groupBy(*PAGE).agg(F.count("*").alias("n"), F.first("extent").alias("extent"), F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"))
    a, b = F.greatest(F.col("_lo"), F.col("k0").cast("int")), F.least(F.col("_hi"), F.col("k1").cast("int"))
    ends = l.select(*PAGE, a.alias("a"), b.alias("b")).where("a < b").select(*PAGE, F.explode(F.array(F.struct(F.col("a").alias("x"), F.lit(1).alias("d")), F.struct(F.col("b").alias("x"), F.lit(-1).alias("d")))).alias("e"))
    places = pages.where("_lo < _hi").select(*PAGE, F.explode(F.sequence(F.col("_lo"), F.col("_hi") - 1)).alias("x"), F.lit(0).alias("d"))
    steps = places.unionByName(ends.select(*PAGE, "e.x", "e.d")).groupBy(*PAGE, "x").agg(F.sum("d").alias("d"))
    order = Window.partitionBy(*PAGE).orderBy("x")
    steps = steps.withColumn("over", F.sum("d").over(order.rowsBetween(Window.unboundedPreceding, 0))).join(pages, PAGE).where("x >= _lo and x < _hi")
    limit = F.greatest(F.lit(1), (F.col("n") * GUTTER_LINES).cast("int"))
    free = steps.where(F.col("over") <= limit).withColumn("_island", F.col("x") - F.row_number().over(order))
    islands = free.groupBy(*PAGE, "_island", "extent", "n").agg(F.min("x").alias("start"), F.count("*").alias("width"))
    best = islands.withColumn("_k", ranked([F.desc("width"), F.col("start")])).where("_k = 0").where(F.col("width") >= F.col("extent") * GUTTER_WIDTH)
    best = best.select(*PAGE, "n", (F.col("start") + F.col("width") / 2).alias("split"))
    first = l.join(best, PAGE).groupBy(*PAGE, "n", "split").agg(F.count(F.when(F.col("k0") < F.col("split"), 1)).alias("first"))
    return first.where(F.least(F.col("first"), F.col("n") - F.col("first")) >= F.col("n") * GUTTER_SIDE).select(*PAGE, "split")


def rows_of(lines: DataFrame, sizes: DataFrame) -> DataFrame:
    """Visual rows of a page; sizes has page keys, width, height. Returns page keys, row (from 0), row_text."""
    page = Window.partitionBy(*PAGE)
    l = lines.withColumn("_v", F.sum(F.col("vertical").cast("int")).over(page) * 2 > F.count("*").over(page)).join(sizes, PAGE)
    l = l.withColumn("extent", F.when(F.col("_v"), F.coalesce("height", "width")).otherwise(F.col("width")).cast("double"))
    l = l.withColumn("k0", F.when(F.col("_v"), F.col("y0")).otherwise(F.col("x0"))).withColumn("k1", F.when(F.col("_v"), F.col("y1")).otherwise(F.col("x1")))
    l = l.join(find_gutter(l), PAGE, "left").withColumn("_column", F.coalesce((F.col("k0") >= F.col("split")).cast("int"), F.lit(0)))
    order = Window.partitionBy(*PAGE, "_column").orderBy(*reading_key(F.col("_v")))
    before = {c: F.lag(c).over(order) for c in ("x0", "w", "y1", "h")}
    joined = F.when(F.col("_v"), F.col("x1") > before["x0"] + before["w"] * SAME_ROW).otherwise(F.col("y0") < before["y1"] - before["h"] * SAME_ROW)
    l = l.withColumn("_rank", F.row_number().over(order)).withColumn("_new", F.when(joined, 0).otherwise(1))
    l = l.withColumn("_row", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    inner = F.struct(F.when(F.col("_v"), F.col("y0")).otherwise(F.col("x0")).alias("k"), F.col("_rank").alias("n"), X.strip(F.col("text")).alias("t"))
    rows = l.groupBy(*PAGE, "_column", "_row").agg(F.array_join(F.transform(F.array_sort(F.collect_list(inner)), lambda s: s["t"]), "　").alias("row_text"))
    rows = rows.withColumn("row_text", X.normalize(F.col("row_text"))).where("row_text <> ''")
    return rows.withColumn("row", ranked([F.col("_column"), F.col("_row")])).drop("_column", "_row")


ELEMENT = ["el", "nth", "etype", "box", "direction", "role", "contents", "n_row", "n_col", "cells", "labels"]


def elements_of(pages: DataFrame) -> Column:
    """G19 within a page: its paragraphs, tables and figures, ranked by `order`, then kind, then place; nth counts a kind."""
    cells = pages.schema["tables"].dataType.elementType["cells"].dataType.simpleString()
    kinds = {"box": "array<double>", "direction": "string", "role": "string", "contents": "string", "n_row": "int", "n_col": "int", "cells": cells, "labels": "array<string>"}
    own = {"paragraphs": ("p", ["box", "direction", "role", "contents"]), "tables": ("t", ["box", "n_row", "n_col", "cells"]), "figures": ("f", ["box"])}

    def part(rank: int, column: str) -> Column:
        def element(e: Column, n: Column) -> Column:
            given = {c: e[c] for c in own[column][1]} | ({"labels": F.transform(e["paragraphs"], lambda p: p["contents"])} if column == "figures" else {})
            values = (given.get(c, F.lit(None)).cast(t).alias(c) for c, t in kinds.items())
            return F.struct(e["order"].cast("long").alias("order"), F.lit(rank).alias("kind"), n.alias("n"), F.lit(own[column][0]).alias("etype"), *values)

        return F.transform(F.coalesce(F.col(column), F.array().cast(pages.schema[column].dataType)), element)

    def ranked_in(es: Column) -> Column:
        nth = lambda e, k: F.when(e["etype"] == "f", F.size(F.filter(F.slice(es, 1, k + 1), lambda x: x["etype"] == "f")))
        return F.transform(es, lambda e, k: F.struct(k.alias("el"), nth(e, k).alias("nth"), *(e[c].alias(c) for c in ELEMENT[2:])))

    return X.let(F.sort_array(F.concat(*(part(k, c) for k, c in enumerate(own)))), ranked_in)


def owners(lines: Column, els: Column) -> Column:
    """G7 within a page: the elements, each with `lines`: those whose first element it is that, a little widened, holds
    their centre, as structs of text, size, offset in reading order."""

    def holds(b: Column, l: Column) -> Column:
        cx, cy = (l["x0"] + l["x1"]) / 2, (l["y0"] + l["y1"]) / 2
        return cx.between(b[0] - SLACK, b[2] + SLACK) & cy.between(b[1] - SLACK, b[3] + SLACK)

    def taken(own: Column) -> Column:
        def filled(e: Column) -> Column:
            v = F.coalesce(e["direction"] == "vertical", F.lit(False))
            key = lambda l: F.struct(F.when(v, -l["x0"]).otherwise(l["y0"]).alias("k1"), F.when(v, l["y0"]).otherwise(l["x0"]).alias("offset"), l["ord"].alias("ord"), l["text"].alias("text"), F.when(v, l["w"]).otherwise(l["h"]).alias("size"))
            mine = F.transform(F.filter(own, lambda o: o["el"] == e["el"]), lambda o: key(o["l"]))
            return F.struct(*(e[c].alias(c) for c in ELEMENT), F.sort_array(mine).alias("lines"))

        return F.transform(els, filled)

    first = lambda l: F.get(F.filter(els, lambda e: holds(e["box"], l)), F.lit(0))["el"]
    return X.let(F.transform(lines, lambda l: F.struct(first(l).alias("el"), l.alias("l"))), taken)


def take_lines(lines: DataFrame, boxes: DataFrame) -> DataFrame:
    """(line, el): each line goes to the first element whose box, widened a little, holds its centre."""
    l, e = lines.alias("l"), boxes.select(*PAGE, "el", "box").alias("e")
    cx, cy = (F.col("l.x0") + F.col("l.x1")) / 2, (F.col("l.y0") + F.col("l.y1")) / 2
    box = F.col("e.box")
    inside = cx.between(box[0] - SLACK, box[2] + SLACK) & cy.between(box[1] - SLACK, box[3] + SLACK)
    pairs = l.join(e, (F.col("l.book_id") == F.col("e.book_id")) & (F.col("l.page") == F.col("e.page")) & inside).select("l.*", "e.el")
    return pairs.withColumn("_k", ranked([F.col("el")], [*PAGE, "ord"])).where("_k = 0").drop("_k")


def chapter_title(lines: Column, texts: Column) -> Column:
    """G8 within a page: titles if it is a chapter's title page, else null: number tokens from the left, title from the
    right; texts has the normalized text of each line."""
    t = F.zip_with(lines, texts, lambda l, x: F.struct(l["x0"].alias("x0"), l["ord"].alias("ord"), F.replace(x, F.lit(" "), F.lit("")).alias("t")))
    t = F.filter(t, lambda x: x["t"] != "")
    number = lambda x: x["t"].rlike(r"^(第|章|\d{1,2})$") | x["t"].rlike("^[序終]章$")

    def told(parts: Column, x0) -> Column:
        return F.array_join(F.transform(F.sort_array(F.transform(parts, lambda x: F.struct(x0(x).alias("k"), x["ord"].alias("ord"), x["t"].alias("t")))), lambda x: x["t"]), "")

    heads = F.struct(told(F.filter(t, number), lambda x: x["x0"]).alias("head"), told(F.filter(t, lambda x: ~number(x)), lambda x: -x["x0"]).alias("title"))
    is_head = lambda h: h["head"].rlike(r"^第\d{1,2}章$") | h["head"].rlike("^[序終]章$")
    return X.let(heads, lambda h: F.when(is_head(h), F.filter(F.array(h["head"], h["title"]), lambda x: x != "")))
