
from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import patterns as P

MANY = 1 << 30


def let(value: Column, body) -> Column:
    """body(value), with value evaluated once."""
    return F.transform(F.array(value), body)[0]


def strip(s: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.regexp_replace(s, r"(?U)^\s+|\s+\z", "")


def replace_all(s: Column, pattern: str, change, between=None) -> Column:
    """s with change(match, index) for each match of a pattern and, if given, between(gap) for what lies between."""
    gaps = F.split(s, pattern, -1)
    gaps = F.transform(gaps, between) if between else gaps
    matches = F.regexp_extract_all(s, F.lit(pattern), 0)
    changed = F.transform(matches, change) if change else matches
    return F.array_join(F.zip_with(gaps, changed, lambda g, m: F.concat(g, F.coalesce(m, F.lit("")))), "")


_KEPT = re.compile(f"([{P.ANNOTATION_SAFE}])")


def nfkc_text(s: str | None) -> str | None:
    """NFKC of all but roman part numbers and ruby marks."""
    if s is None or s.isascii():
        return s
    return "".join(x if k % 2 else unicodedata.normalize("NFKC", x) for k, x in enumerate(_KEPT.split(s)))


@F.pandas_udf(T.StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """First rules of T1; Spark has no Unicode normalization of its own."""
    return s.map(nfkc_text)


@F.pandas_udf(T.ArrayType(T.StringType()))
def nfkc_lines(lines: pd.Series) -> pd.Series:
    return lines.map(lambda xs: None if xs is None else [nfkc_text(x) for x in xs])


#: What some rule of T1 may change; a line without it, of plain Latin letters and marks, stays as it is.
TOUCHED = r"[^\x20-\x7eÀ-ÖØ-öø-ÿ]|[()\[\]{}?!;%&~]|--|  |^ | \z"


def tidy(s: Column) -> Column:
    """T1 after NFKC: dashes, punctuation (T2), marks beside CJK characters (T3), blanks."""
    return F.when(s.rlike(TOUCHED), _tidied(s)).otherwise(s)


def _tidied(s: Column) -> Column:
    s = F.regexp_replace(s, f"[{P.DASHES}]{{2,}}", "――")
    s = F.translate(s, P.PUNCTUATION_FROM, P.PUNCTUATION_TO)
    for pattern, by in (
        (f"(?<=[{P.CJK}]):", "："),
        (f":(?=[{P.CJK}])", "："),
        (f"(?<=[{P.CJK}]),", "、"),
        (rf"(?<=[{P.CJK}])\.(?=[{P.CJK}])", "。"),
        (f"(?<=[{P.CJK}])[ 　]+", ""),
        (f"[ 　]+(?=[{P.CJK}])", ""),
        (r"[ \t]{2,}", " "),
    ):
        s = F.regexp_replace(s, pattern, by)
    return strip(s)


def normalize(s: Column) -> Column:
    """T1. Plain ASCII is its own NFKC, so such text isn't sent to Python."""
    other = s.rlike(r"[^\x00-\x7f]")
    return tidy(F.when(other, nfkc(F.when(other, s))).otherwise(s))


def normalize_lines(lines: Column) -> Column:
    other = F.exists(lines, lambda l: l.rlike(r"[^\x00-\x7f]"))
    return F.transform(F.when(other, nfkc_lines(F.when(other, lines))).otherwise(lines), tidy)


def is_split_token(left: Column, right: Column) -> Column:
    """T4: whether a line end and the next start are one word cut in two, both beside CJK text."""
    tail = F.regexp_extract(left, f"(?<=[{P.CJK}])([0-9A-Za-z]+)$", 1)
    head = F.regexp_extract(right, f"^([0-9A-Za-z]+)(?=[{P.CJK}])", 1)
    digits = tail.rlike(r"^\d+$") & head.rlike(r"^\d+$")
    capitals = tail.rlike("^[A-Z]+$") & head.rlike("^[A-Z]+$") & (F.least(F.length(tail), F.length(head)) == 1)
    return digits | capitals


def join_lines(lines: Column) -> Column:
    """T5: one line of wrapped ones; a space only between Latin words that aren't one word cut in two."""

    def add(out: Column, line: Column) -> Column:
        # Only the last character of what is joined so far is looked at, unless both sides are Latin.
        apart = F.right(out, F.lit(1)).rlike("[0-9A-Za-z]") & line.rlike("^[0-9A-Za-z]") & ~is_split_token(out, line)
        return F.concat(out, F.when(apart, F.lit(" ")).otherwise(F.lit("")), line)

    filled = F.filter(F.transform(lines, strip), lambda x: x != "")
    return F.aggregate(filled, F.lit(""), add)


def roman_value(token: Column) -> Column:
    """struct(value, sure) of a part number as read; look-alikes of I count as I."""
    t = F.regexp_replace(strip(token), " ", "")
    shaped = F.translate(t, "lLi|｜ｌ[]f{}!", "I" * 12)
    shaped = F.regexp_replace(F.regexp_replace(F.regexp_replace(shaped, "Ⅰ", "I"), "Ⅱ", "II"), "Ⅲ", "III")
    value = (
        F.when(t == "川", 3)
        .when(shaped.rlike("^I{1,5}$"), F.length(shaped))
        .when(t.rlike("^1{2,5}$"), F.length(t))
        .when(t.rlike("^[1-5]$"), F.expr("null"))
    )
    lone = t.rlike("^[1-5]$")
    return F.struct(F.when(lone, t.try_cast("int")).otherwise(value.cast("int")).alias("value"), value.isNotNull().alias("sure"))


def subtitle_dash(lines: Column) -> Column:
    """Of three lines or more, the last is framed by dashes."""

    def framed(last: Column) -> Column:
        closed = F.regexp_replace(last, f"[{P.DASHES}]+$", "――")
        return F.when(closed.startswith("――"), closed).otherwise(F.concat(F.lit("――"), closed))

    n = F.size(lines)
    return F.when(n >= 3, F.concat(F.slice(lines, F.lit(1), F.greatest(n - 1, F.lit(0))), F.transform(F.slice(lines, F.greatest(n, F.lit(1)), F.lit(1)), framed))).otherwise(lines)


def without_page_number(title: Column) -> Column:
    """Without a page number behind a word of the vocabulary; ordinals stay."""
    word = F.regexp_extract(title, P.NUMBERED_PAGE_RE, 1)
    return F.when(word != "", word).otherwise(title)


def first_line(text: Column) -> Column:
    return F.split(text, "\n", 2)[0]


def front_back_title(text: Column) -> Column:
    """Title of a front or back part, else ''."""
    title = without_page_number(normalize(first_line(text)))
    return F.when(title.rlike(P.FRONT_BACK_HEADER_RE) | title.rlike(P.UNNUMBERED_RE), title).otherwise(F.lit(""))


def level_of(head: Column, token: Column) -> Column:
    """T12 of a normalized first line and its normalized first token."""
    large = head.rlike(P.PART_LOOSE_RE) | head.rlike(r"^第\s*\d+\s*章") | head.rlike(P.COLUMN_RE)
    for x in (token, head):
        large = large | x.rlike(P.UNNUMBERED_RE) | x.rlike(P.FRONT_BACK_RE)
    return F.when(large, "大").when(head.rlike(r"^\d+\s*[-‐−–—－]\s*\d+"), "中").otherwise("小")


def heading_level(text: Column) -> Column:
    """Level of a heading as read."""
    line = strip(first_line(text))
    return level_of(normalize(line), normalize(F.split(line, "[ \t　]", 2)[0]))


def strip_ruby(s: Column) -> Column:
    """T13."""
    return F.replace(F.regexp_replace(F.regexp_replace(s, P.RUBY_PIPE, "$1"), P.RUBY_BARE, "$1"), F.lit("｜"), F.lit(""))


def escape(s: Column) -> Column:
    """T15 in text."""
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        s = F.replace(s, F.lit(a), F.lit(b))
    return s


def escape_attr(s: Column) -> Column:
    """T15 in attribute values."""
    return F.replace(escape(s), F.lit('"'), F.lit("&quot;"))


def render_plain(s: Column) -> Column:
    """T14."""
    return escape(strip_ruby(s))


def upright(html: Column) -> Column:
    """In text nodes only, digits, capitals and pairs of marks stand upright."""

    def tcy(x: Column) -> Column:
        return F.concat(F.lit('<span class="tcy">'), x, F.lit("</span>"))

    def stand(m: Column, _=None) -> Column:
        full = lambda x: F.translate(x, P.HALF, P.FULL)
        digits = F.array_join(F.transform(F.split(m, r"\."), lambda d: F.when(F.length(d) == 2, tcy(d)).otherwise(full(d))), "・")
        return F.when(m.rlike("^[!?！？]"), tcy(F.translate(m, "！？", "!?"))).when(m.rlike("^[A-Z]"), full(m)).otherwise(digits)

    return replace_all(html, P.MARKUP, None, lambda text: replace_all(text, P.UPRIGHT, stand))


def render_inline(s: Column, vertical: bool = True) -> Column:
    """T16."""
    ruby = "<ruby>$1<rp>（</rp><rt>$2</rt><rp>）</rp></ruby>"
    out = F.regexp_replace(F.regexp_replace(escape(s), P.RUBY_PIPE, ruby), P.RUBY_BARE, ruby)
    return upright(out) if vertical else out


def join_title(parts: Column) -> Column:
    """T18 of normalized lines."""
    parts = F.filter(F.transform(parts, without_page_number), lambda p: p != "")
    return let(subtitle_dash(parts), lambda xs: F.aggregate(xs, F.lit(""), lambda out, p: F.concat(out, F.when((out == "") | p.startswith("――"), "").otherwise("　"), p)))


def heading_title(lines: Column) -> Column:
    """Heading lines as one title."""
    return join_title(normalize_lines(lines))


def roman_to_int(s: Column) -> Column:
    """Value of a roman page number, null if it is none."""
    values = F.transform(F.reverse(F.split(F.lower(s), "")), lambda c: F.when(c == "i", 1).when(c == "v", 5).when(c == "x", 10).when(c == "l", 50).when(c == "c", 100))
    start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("top"))
    step = lambda a, v: F.struct((a["total"] + F.when(v < a["top"], -v).otherwise(v)).alias("total"), F.greatest(a["top"], v).alias("top"))
    total = F.aggregate(values, start, step, lambda a: a["total"])
    return F.when(F.lower(s).rlike("^[ivxlc]+$") & (total != 0), total)


def page_set(spec: Column) -> Column:
    """Sorted distinct pages of a list like "1,10-13"."""
    parts = F.filter(F.transform(F.split(spec, ","), strip), lambda p: p != "")

    def pages(p: Column) -> Column:
        ends = F.transform(F.split(p, "-", 2), lambda x: strip(x).cast("int"))
        low, high = ends[0], F.element_at(ends, -1)
        return F.when(high >= low, F.sequence(low, F.greatest(low, high))).otherwise(F.array().cast("array<int>"))

    return F.array_sort(F.array_distinct(F.flatten(F.transform(parts, pages))))
