import io
import zipfile

import pytest
from pyspark.sql import functions as F

from quirewise.operators import checks, metadata as M, render as R
from quirewise.plans.carriers import build_package
from quirewise.operators.structure import split_chapters

FEED = """<rss xmlns:dc="d" xmlns:dcndl="n"><channel>
<item><title>甲</title><link>l1</link><category>図書</category><dc:creator>山田, 太郎, 1950- 著</dc:creator><dc:identifier>x</dc:identifier><dc:identifier>4003101014</dc:identifier><dcndl:seriesTitle>s</dcndl:seriesTitle><dc:date>1996</dc:date></item>
<item><title>乙</title><link>l2</link><category>記事</category></item>
<item><title>甲 別</title><link>l3</link><category>図書</category><dc:identifier>4-00-310101-4</dc:identifier></item>
<item><title></title><category>図書</category></item></channel></rss>"""


def test_feeds(spark):
    feeds = spark.createDataFrame([(1, FEED), (2, "<broken"), (3, None)], "request int, xml string")
    got = M.parse_items(feeds, ["request"]).collect()
    assert [(r.request, r.pos, r.title, r.author, r.series, r.pubdate, r.source) for r in got] == [(1, 0, "甲", "山田太郎", "s", "1996", "NDLサーチ")]
    assert M.search(M.parse_items(feeds, ["request"], books_only=False), ["request"], 1).count() == 1


def test_lookup_prefers_the_first_source(spark):
    requests = spark.createDataFrame([(1, "4003101014"), (2, "4003101014"), (3, "bad")], "request int, isbn string")
    record = ({"DescriptiveDetail": {"Contributor": [{"PersonName": {"content": "甲 著"}}]}}, {"isbn": "4003101014", "title": " 題 ", "pubdate": "199603", "author": "乙"})
    first = spark.createDataFrame([(1, record)], f"request int, record {M.OPENBD}")
    second = spark.createDataFrame([(1, FEED), (2, FEED)], "request int, xml string")
    got = {r.request: (r.title, r.author, r.source, r.pubdate) for r in M.lookup(requests, first, second).collect()}
    assert got == {1: ("題", "甲", "openBD", "1996.3"), 2: ("甲", "山田太郎", "NDLサーチ", "1996")}


def test_summary(spark):
    frame = spark.createDataFrame([("", "題", "甲", "", "", "", "")], "isbn string, title string, author string, publisher string, series string, pubdate string, extent string")
    assert frame.select(M.summary_lines().alias("x")).first().x == ["書名: 題", "著者: 甲"]


BLOCK = "book_id string, seq int, kind string, level string, lines array<string>, text string, page int, n_row int, n_col int, cells array<struct<row:int,col:int,row_span:int,col_span:int,contents:string>>, src string, alt string"


def blocks(spark, *rows):
    full = []
    for i, r in enumerate(rows):
        d = dict.fromkeys(("level", "lines", "text", "n_row", "n_col", "cells", "src", "alt")) | r
        full.append(("b", i, d["kind"], d["level"], d["lines"], d["text"], 1, d["n_row"], d["n_col"], d["cells"], d["src"], d["alt"]))
    return spark.createDataFrame(full, BLOCK)


TABLE = {"kind": "table", "n_row": 2, "n_col": 3, "cells": [(1, 1, 2, 1, "甲\n乙"), (1, 2, None, 2, "2.2"), (2, 3, 1, 1, "12")]}
TABLE_HTML = '<table class="h-table">\n<tr><td rowspan="2">甲乙</td><td colspan="2">2.2</td></tr>\n<tr><td></td><td>12</td></tr>\n</table>'


def test_block_rendering(spark):
    b = blocks(spark, {"kind": "para", "lines": ["大きく、20", "15年"]}, {"kind": "raw", "text": "a<b"}, {"kind": "heading", "level": "中", "lines": ["題", "副"]}, TABLE, {"kind": "figure", "src": "f.png", "alt": '｜親《ふ》"'}, {"kind": "para", "lines": [" "]})
    html = [r.html for r in R.blocks_html(b.withColumn("id", F.when(F.col("seq") == 2, "h1"))).orderBy("seq").collect()]
    assert html == ["<p>大きく、２０１５年</p>", "<p>a&lt;b</p>", '<h2 id="h1">題</h2>\n<p class="subtitle">副</p>', TABLE_HTML, '<figure class="h-figure"><img src="../images/f.png" alt="親&quot;"/></figure>', ""]
    with pytest.raises(Exception, match="unknown kind"):
        R.blocks_html(blocks(spark, {"kind": "odd"})).collect()


def test_plain_text(spark):
    b = blocks(spark, {"kind": "heading", "level": "大", "lines": ["第1章", "題"]}, {"kind": "heading", "level": "小", "lines": ["節"]}, {"kind": "para", "lines": ["本", "文"]}, TABLE, {"kind": "figure", "src": "f.png"})
    got = R.plain_text(b, "fig", F.lit("H\n\n\n\n"), F.lit("\nF")).first()
    assert got.text == "H\n\n［＃改ページ］\n［＃ここから大見出し］\n第1章\n題\n［＃ここで大見出し終わり］\n節［＃「節」は小見出し］\n　本文\n［＃ここから罫囲み］\n甲乙　2.2\n12\n［＃ここで罫囲み終わり］\n［＃挿絵（fig/f.png）入る］\nF"
    assert (got.paragraphs, got.headings, got.tables, got.pictures) == (1, 2, 1, 1)


@pytest.fixture(scope="module")
def package(spark):
    b = blocks(spark, {"kind": "heading", "level": "大", "lines": ["第1章"]}, {"kind": "para", "lines": ["本文"]}, {"kind": "heading", "level": "大", "lines": ["第2章"]})
    chapters, nav = split_chapters(b)
    books = spark.createDataFrame([("b", "題 & <x>", "甲", "", "urn:uuid:1", "2000-01-01T00:00:00Z", "text/ch000.xhtml")], "book_id string, title string, author string, publisher string, identifier string, modified string, first_href string")
    return build_package(chapters, nav, books)


def test_package_is_right(package):
    packages, problems = package
    assert problems.collect() == []
    with zipfile.ZipFile(io.BytesIO(bytes(packages.first().epub))) as z:
        first = z.infolist()[0]
        assert (first.filename, first.compress_type, z.read("mimetype")) == ("mimetype", zipfile.ZIP_STORED, b"application/epub+zip")
        assert 'page-progression-direction="rtl"' in z.read("OEBPS/package.opf").decode()


def test_broken_packages_are_found(spark, package):
    entries = R.read_zips(package[0])
    assert {r.rule for r in checks.self_check(entries, horizontal=True).collect()} == {"V9", "V10", "V11"}
    broken = entries.where("name <> 'OEBPS/text/ch001.xhtml'").withColumn("stored", F.lit(False))
    extra = spark.createDataFrame([("b", 99, "OEBPS/x.xhtml", False, bytearray(b"<a>"))], "book_id string, pos int, name string, stored boolean, bytes binary")
    assert {r.rule for r in checks.self_check(broken.unionByName(extra)).collect()} == {"V1 stored", "V2", "V4", "V12"}
    assert {r.rule for r in checks.self_check(entries.where("name not like '%.opf'")).collect()} == {"V3 package"}
