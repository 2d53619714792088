
from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X

EDITS = "array<struct<line:int,before:string,after:string,why:string>>"
# Sizes of chunks, what an annotation looks like, and how far a change may go.
MAX_CHARS, MAX_LINES, LEAST_CHANGE = 6000, 50, 4
ANNOTATION, OPEN_ANNOTATION, HEADING = r"［＃[^］]*］", r"［＃[^］]*(?:］|$)", r"^(.*)［＃「(.*)」は(大|中|小)見出し］$"
BRACKETS, SHELLS = "［］[]", "〔〕〔〕"
# Reasons for refusing an edit, in the order in which they are looked for.
BAD_FORM, BAD_LINE, LINE_BREAK, NO_CHANGE, TOO_MUCH, BAD_RUBY, NOT_UNIQUE, ANNOTATED = (
    "形式不正", "行番号が範囲外", "改行を含む", "変更なし", "変更量が大きすぎる", "ルビ記号が不整合", "before が行に一意に見つからない", "注記に触れている",
)


def flat_lines(blocks: DataFrame, ranges: DataFrame | None = None) -> DataFrame:
    """L1: (book_id, chapter, line_no from 1, line, page) of headings, paragraphs and single lines whose block's page is
    in a range; ranges: book_id, chapter, start, end."""
    b = blocks.where("kind in ('heading', 'para', 'raw')")
    if ranges is not None:
        r = ranges.select("book_id", "chapter", "start", "end")
        b = b.join(r, "book_id").where("page between start and end")
    else:
        b = b.withColumn("chapter", F.lit(0))
    raw = F.col("kind") == "raw"
    b = b.select("book_id", "chapter", "seq", "page", "pages", F.posexplode(F.when(raw, F.array("text")).otherwise(F.col("lines"))).alias("_i", "line"))
    page = F.coalesce(F.get("pages", F.col("_i")), F.col("page"))
    n = F.row_number().over(Window.partitionBy("book_id", "chapter").orderBy("seq", "_i"))
    return b.select("book_id", "chapter", n.alias("line_no"), "line", page.alias("page"))


def chunk_bounds(sizes: Column, max_chars: int = MAX_CHARS, max_lines: int = MAX_LINES) -> Column:
    """L2: array of struct(start, end), both from 0, end excluded, of lines with these sizes (their line break counts)."""
    n = F.size(sizes)
    start = F.struct(F.array().cast("array<struct<start:int,end:int>>").alias("done"), F.lit(0).alias("from"), F.lit(0).cast("long").alias("size"))

    def step(s: Column, i: Column) -> Column:
        size = s["size"] + F.get(sizes, i).cast("long") + 1
        full = (i - s["from"] + 1 >= max_lines) | (size >= max_chars)
        done = F.concat(s["done"], F.array(F.struct(s["from"].alias("start"), (i + 1).alias("end"))))
        return F.struct(F.when(full, done).otherwise(s["done"]).alias("done"), F.when(full, i + 1).otherwise(s["from"]).alias("from"), F.when(full, F.lit(0).cast("long")).otherwise(size).alias("size"))

    rest = lambda s: F.when(s["from"] < n, F.concat(s["done"], F.array(F.struct(s["from"].alias("start"), n.alias("end"))))).otherwise(s["done"])
    places = F.when(n > 0, F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(places, start, step, rest)


def chunk_lines(lines: DataFrame, keys: list[str], max_chars: int = MAX_CHARS, max_lines: int = MAX_LINES) -> DataFrame:
    """L2: keys, chunk_idx, offset (lines before the chunk), lines of each chunk of lines(keys, line_no, line)."""
    doc = lines.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]).alias("_all"))
    doc = doc.withColumn("_sizes", F.transform("_all", lambda l: F.length(l)))
    doc = doc.select(*keys, "_all", F.posexplode(chunk_bounds(F.col("_sizes"), max_chars, max_lines)).alias("chunk_idx", "c"))
    return doc.select(*keys, "chunk_idx", F.col("c.start").alias("offset"), F.slice("_all", F.col("c.start") + 1, F.col("c.end") - F.col("c.start")).alias("lines"))


def chunk_key(model: Column, context: Column, offset: Column, lines: Column) -> Column:
    """L3: 12 hex digits of what a chunk's answer depends on; lines: array<string>."""
    parts = F.concat(F.array(model, context, offset.cast("string")), lines)
    return F.substring(F.sha2(F.array_join(parts, "\0"), 256), 1, 12)


def extract_json(answer: Column) -> Column:
    """Edits of an answer: its fenced part if it has one, from the first [ to the last ]; else none."""
    text = X.strip(answer)
    fenced = F.regexp_extract(text, r"(?s)```(?:json)?\s*(.+?)```", 1)
    text = F.when(fenced != "", X.strip(fenced)).otherwise(text)
    return F.coalesce(F.from_json(F.regexp_extract(text, r"(?s)\[.*\]", 0), EDITS), F.array().cast(EDITS))


def run_chunks(chunks: DataFrame, cache: DataFrame, provider: Callable[[list[str], int], str | None], parallel: int = 4) -> tuple[DataFrame, DataFrame]:
    """L4: (answers, failures). Chunks whose key is in cache(key, edits) aren't asked for again; provider(lines, offset)
    gives an answer or None. Equal chunks, of whatever book, are asked for once and have one answer. answers: key, edits,
    a row a key; only they may go into the cache. failures: the keys without an answer."""
    known = cache.groupBy("key").agg(F.first("edits").alias("edits"))
    each = chunks.select("key", "offset", "lines").dropDuplicates(["key"])
    hits = known.join(each.select("key"), "key", "left_semi")
    missing = each.join(cache.select("key"), "key", "left_anti").repartition(parallel)

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            f["answer"] = [provider(list(lines), int(offset)) for lines, offset in zip(f["lines"], f["offset"])]
            yield f[["key", "answer"]]

    asked = missing.mapInPandas(ask, "key string, answer string")
    good = asked.where("answer is not null").select("key", extract_json(F.col("answer")).alias("edits"))
    return hits.unionByName(good), asked.where("answer is null").select("key")


def sanitize(s: Column) -> Column:
    """Brackets become shell brackets outside of annotations."""
    return X.replace_all(s, OPEN_ANNOTATION, None, lambda gap: F.translate(gap, BRACKETS, SHELLS))


def occurrences(line: Column, part: Column) -> Column:
    return F.floor((F.length(line) - F.length(F.replace(line, part, F.lit("")))) / F.greatest(F.length(part), F.lit(1))).cast("int")


def locate(line: Column, before: Column) -> Column:
    """Place from 0 where `before` stands once, also with brackets taken for shell brackets; else null."""
    n = occurrences(line, before)
    a, b = F.translate(line, BRACKETS, SHELLS), F.translate(before, BRACKETS, SHELLS)
    return F.when(n == 1, F.instr(line, before) - 1).when((n == 0) & (occurrences(a, b) == 1), F.instr(a, b) - 1)


def verdict(line: Column, n_lines: Column, line_no: Column, before: Column, after: Column) -> Column:
    """struct(ok, reason, pos, after) of an edit of one line; `line` is null if line_no is out of range."""

    def judge(clean: Column) -> Column:
        pos = locate(line, before)
        end = pos + F.length(before)
        applied = F.concat(F.substring(line, F.lit(1), pos), clean, F.substring(line, end + 1, F.lit(X.MANY)))
        notes, gaps = F.regexp_extract_all(line, F.lit(ANNOTATION), 0), F.split(line, ANNOTATION, -1)
        size = lambda xs, k: F.aggregate(F.slice(xs, F.lit(1), k), F.lit(0), lambda n, x: n + F.length(x))
        starts = F.transform(notes, lambda m, k: F.struct((size(gaps, k + 1) + size(notes, k)).alias("a"), (size(gaps, k + 1) + size(notes, k + 1)).alias("b")))
        touched = F.exists(starts, lambda s: (s["a"] < end) & (pos < s["b"])) & ~(line.rlike(HEADING) & applied.rlike(HEADING))
        reason = (
            F.when(line_no.isNull() | before.isNull() | after.isNull(), BAD_FORM)
            .when(~line_no.between(F.lit(1), n_lines), BAD_LINE)
            .when(after.rlike("[\n\r]"), LINE_BREAK)
            .when((before == "") | (before == clean), NO_CHANGE)
            .when(F.abs(F.length(clean) - F.length(before)) > F.greatest(F.lit(LEAST_CHANGE), F.length(before)), TOO_MUCH)
            .when(occurrences(clean, F.lit("《")) != occurrences(clean, F.lit("》")), BAD_RUBY)
            .when(pos.isNull(), NOT_UNIQUE)
            .when(touched, ANNOTATED)
            .otherwise("")
        )
        return F.struct((reason == "").alias("ok"), reason.alias("reason"), F.when(reason == "", pos).otherwise(-1).alias("pos"), clean.alias("after"))

    return X.let(sanitize(after), judge)


def applied(line: Column, pos: Column, before: Column, after: Column) -> Column:
    return F.concat(F.substring(line, F.lit(1), pos), after, F.substring(line, pos + F.length(before) + 1, F.lit(X.MANY)))


def repair_headings(line: Column) -> Column:
    """The copy in a heading's annotation is made that of the heading."""
    body, copy, level = (F.regexp_extract(line, HEADING, k) for k in (1, 2, 3))
    return F.when(line.rlike(HEADING) & (body != copy), F.concat(body, F.lit("［＃「"), body, F.lit("」は"), level, F.lit("見出し］"))).otherwise(line)


def apply_edits(lines: DataFrame, edits: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(lines, log) after the edits in order; later ones see what earlier ones left.

    Edits of one line are a fold over that line; edits of other lines don't meet them, so lines are independent. lines:
    keys, line_no, line; edits: keys, ord, line_no, before, after, why. log adds ok, reason and the text put in.
    """
    total = lines.groupBy(*keys).agg(F.max("line_no").alias("n_lines"))
    e = edits.groupBy(*keys, "line_no").agg(F.array_sort(F.collect_list(F.struct("ord", "before", "after", "why"))).alias("_edits"))
    j = e.join(lines, [*keys, "line_no"], "left").join(total, keys, "left")
    kind = "array<struct<ord:int,before:string,after:string,why:string,ok:boolean,reason:string>>"
    start = F.struct(F.col("line").alias("line"), F.array().cast(kind).alias("log"))

    def step(s: Column, x: Column) -> Column:
        def put(v: Column) -> Column:
            row = F.struct(x["ord"].cast("int").alias("ord"), x["before"].alias("before"), v["after"].alias("after"), x["why"].alias("why"), v["ok"].alias("ok"), v["reason"].alias("reason"))
            return F.struct(F.when(v["ok"], applied(s["line"], v["pos"], x["before"], v["after"])).otherwise(s["line"]).alias("line"), F.concat(s["log"], F.array(row)).alias("log"))

        return X.let(verdict(s["line"], F.coalesce("n_lines", F.lit(0)), F.col("line_no"), x["before"], x["after"]), put)

    done = j.withColumn("_r", F.aggregate("_edits", start, step))
    log = done.select(*keys, "line_no", F.explode("_r.log").alias("x")).select(*keys, "line_no", "x.*")
    new = done.where("line is not null").select(*keys, "line_no", F.col("_r.line").alias("_new"))
    return lines.join(new, [*keys, "line_no"], "left").withColumn("line", F.coalesce("_new", "line")).drop("_new"), log


def proofread(blocks: DataFrame, ranges: DataFrame, cache: DataFrame, provider, model: str, context: str, max_chars: int = MAX_CHARS, max_lines: int = MAX_LINES) -> tuple[DataFrame, DataFrame]:
    """(fixes, failures) of chapters: lines, chunks, answers from the cache or the provider, edits that hold.

    fixes: book_id, chapter, ord, page, before, after, why. A failed chunk is a row of failures, for the caller to refuse.
    """
    keys = ["book_id", "chapter"]
    lines = flat_lines(blocks, ranges)
    chunks = chunk_lines(lines, keys, max_chars, max_lines).withColumn("key", chunk_key(F.lit(model), F.lit(context), F.col("offset"), F.col("lines")))
    answers, failures = run_chunks(chunks, cache, provider)
    failures = chunks.select(*keys, "chunk_idx", "key").join(failures, "key", "left_semi")
    edits = chunks.select(*keys, "key", "chunk_idx").join(answers, "key").select(*keys, "chunk_idx", F.posexplode("edits").alias("_i", "e"))
    n = F.row_number().over(Window.partitionBy(*keys).orderBy("chunk_idx", "_i"))
    edits = edits.select(*keys, n.alias("ord"), F.col("e.line").alias("line_no"), "e.before", "e.after", "e.why")
    _, log = apply_edits(lines.drop("page"), edits, keys)
    fixes = log.where("ok").join(lines.select(*keys, "line_no", "page"), [*keys, "line_no"])
    return fixes.select(*keys, "ord", "page", "before", "after", F.coalesce("why", F.lit("")).alias("why")), failures


def unique_matches(lines: DataFrame, fixes: DataFrame, keys: list[str]) -> DataFrame:
    """L10, one round: for each fix the line that it goes to, or the reason why to none.

    lines: keys, line_id, page, line; fixes: keys, ord, page, before, after. A fix matches lines of its page in which
    `before` stands exactly once; without one, those of the pages beside it, if there is exactly one.
    """
    f = fixes.withColumn("_near", F.explode(F.array(F.lit(0), F.lit(-1), F.lit(1)))).withColumn("_page", F.col("page") + F.col("_near"))
    l = lines.select(*keys, F.col("page").alias("_page"), "line_id", "line")
    hits = f.join(l, [*keys, "_page"]).where((F.col("before") != "") & (occurrences(F.col("line"), F.col("before")) == 1))
    by = hits.groupBy(*keys, "ord").agg(
        F.count(F.when(F.col("_near") == 0, 1)).alias("here"), F.count(F.when(F.col("_near") != 0, 1)).alias("near"),
        F.min(F.when(F.col("_near") == 0, F.col("line_id"))).alias("_here"), F.min(F.when(F.col("_near") != 0, F.col("line_id"))).alias("_near_id"),
    )
    out = fixes.join(by, [*keys, "ord"], "left").fillna(0, ["here", "near"])
    target = F.when(F.col("here") == 1, F.col("_here")).when((F.col("here") == 0) & (F.col("near") == 1), F.col("_near_id"))
    reason = F.when(F.coalesce(F.col("before"), F.lit("")) == "", "empty").when(F.col("page").isNull(), "no page").when(F.col("here") > 1, "several").when(target.isNull(), "not found").otherwise("")
    return out.withColumn("reason", reason).withColumn("line_id", F.when(reason == "", target)).drop("here", "near", "_here", "_near_id")


def apply_fixes(lines: DataFrame, fixes: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(lines, log). Fixes of a book go in order and may meet each other's results, so each book is one fold, as a
    grouped function over its pages' lines; books are independent."""
    log_schema = ", ".join(f"{k} {dict(lines.dtypes)[k]}" for k in keys) + ", ord int, line_id long, reason string, line string, is_log boolean"

    def fold(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        text = dict(zip(left["line_id"].tolist(), left["line"].tolist()))
        on_page: dict[int, list[int]] = {}
        for i, p in sorted(zip(left["line_id"].tolist(), left["page"].tolist())):
            on_page.setdefault(p, []).append(i)
        log = []
        for ord_, page, before, after in right.sort_values("ord")[["ord", "page", "before", "after"]].itertuples(index=False):
            at, reason = None, ""
            if not before or pd.isna(page):
                reason = "empty" if not before else "no page"
            else:
                once = lambda p: [i for i in on_page.get(p, ()) if text[i].count(before) == 1]  # noqa: B023, E731
                here = once(page)
                found = here or once(page - 1) + once(page + 1)
                if len(found) == 1:
                    at = found[0]
                    text[at] = text[at].replace(before, after)
                else:
                    reason = "several" if here else "not found"
            log.append((*key, ord_, at, reason, None, True))
        rows = [(*key, None, i, None, t, False) for i, t in text.items()] + log
        out = pd.DataFrame(rows, columns=[*keys, "ord", "line_id", "reason", "line", "is_log"])
        return out.astype({"ord": "Int32", "line_id": "Int64"})

    both = lines.select(*keys, "line_id", "page", "line").groupBy(*keys).cogroup(fixes.select(*keys, "ord", "page", "before", "after").groupBy(*keys)).applyInPandas(fold, log_schema)
    new = both.where("not is_log").select(*keys, "line_id", F.col("line").alias("_new"))
    out = lines.join(new, [*keys, "line_id"], "left").withColumn("line", F.coalesce("_new", "line")).drop("_new")
    return out, both.where("is_log").select(*keys, "ord", "line_id", "reason")


def log_rows(log: DataFrame) -> DataFrame:
    """Rows of the log as table lines, applied ones first; bars are escaped."""
    cell = lambda c: F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("|"), F.lit("\\|"))
    row = F.concat(F.lit("| "), F.concat_ws(" | ", *(cell(c) for c in ("line_no", "before", "after"))), F.lit(" | "), F.when(F.col("ok"), cell("why")).otherwise(cell("reason")), F.lit(" |"))
    return log.select("*", row.alias("log_row"))
