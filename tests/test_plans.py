import pytest
from pyspark.sql import functions as F

from quirewise.operators import structure as H
from quirewise.plans import contents as T


def test_parse_row(apply):
    rows = ["第1章 題名 12", "第Ⅱ部 題 iii", "Column 3 話", "はじめに", "終章・あとがき", "本文 3", "第2章", "序章町内会って17", ""]
    got = [tuple(r) if r else None for r in apply(T.parse_row(F.col("x")), rows)]
    assert got == [("大", "第1章 題名", 12, False), ("部", "第Ⅱ部 題", 3, True), ("大", "Column 3 話", None, False), ("大", "はじめに", None, False), None, None, ("大", "第2章", None, False), ("大", "序章町内会って", 17, False), None]


def loop(rows):
    """The rule of C2 as a loop: entries without a number wait, oldest first; numbers that come while none waits are lost."""
    out, waiting = [], []
    for text in rows:
        if text.startswith("第"):
            out.append([text.split()[0], int(text.split()[1]) if len(text.split()) > 1 else None])
            if out[-1][1] is None:
                waiting.append(len(out) - 1)
        else:
            for n in sorted(map(int, text.split())) if text.replace(" ", "").isdigit() else [int(text.split()[-1])] if text.split()[-1].isdigit() else []:
                if waiting:
                    out[waiting.pop(0)][1] = n
    return [tuple(x) for x in out]


@pytest.mark.parametrize("rows", [["5", "第1章", "第2章", "30 20", "第3章", "副題 41", "9"], ["第1章 7", "第2章", "x", "8", "第3章"], ["第1章"], ["3"]])
def test_contents_numbers(spark, rows):
    frame = spark.createDataFrame([("b", 1, i, r) for i, r in enumerate(rows)], "book_id string, page int, row int, row_text string")
    assert [(r.title, r.page_num) for r in T.entries(frame).orderBy("ord").collect()] == loop(rows)


TOC = "book_id string, ord int, level string, title string, page_num int, is_roman boolean"


def plan(spark, pages, offset=2, n=100):
    toc = spark.createDataFrame([("b", i, "大", f"t{i}", p, r) for i, (p, r) in enumerate(pages)], TOC)
    return T.chapter_plan(toc, spark.createDataFrame([("b", offset)], "book_id string, offset int"), spark.createDataFrame([("b", n)], "book_id string, n_pages int"))


def test_chapter_plan(spark):
    got, rejects = plan(spark, [(1, False), (3, True), (10, False), (None, False), (50, False), (200, False)])
    assert [(r.title, r.start, r.end) for r in got.orderBy("ord").collect()] == [("t0", 3, 11), ("t2", 12, 51), ("t4", 52, 100)]
    assert [(r.title, r.reason) for r in rejects.collect()] == [("t5", "range")]
    _, rejects = plan(spark, [(5, False), (5, False)])
    none, rejects = plan(spark, [(5, False), (9, False), (7, False), (12, False), (200, False)])
    assert none.collect() == [] and [(r.ord, r.reason) for r in rejects.collect()] == [(2, "order")]
    with pytest.raises(ValueError, match="order"):
        T.assert_none(rejects, "contents")


def test_front_matter_and_holes(spark):
    got, _ = plan(spark, [(10, False)], 0, 12)
    n = spark.createDataFrame([("b", 12)], "book_id string, n_pages int")
    out = spark.createDataFrame([("b", 1)], "book_id string, page int")
    rest = T.uncovered_pages(got, n, out)
    assert sorted(r.page for r in rest.collect()) == list(range(2, 10))
    assert [(r.title, r.start, r.end) for r in T.cover_front(got, rest).orderBy("ord").collect()] == [("前付", 2, 9), ("t0", 10, 12)]
    assert [(r.start, r.end) for r in T.cover_front(got.where("false"), T.uncovered_pages(got.where("false"), n, out)).collect()] == [(2, 12)]


def test_fixes_by_hand(spark):
    toc = spark.createDataFrame([("b", 0, "大", "第1章 あ", 3, False), ("b", 1, "大", "第2章 い", None, True)], TOC)
    fixes = spark.createDataFrame([("b", "第2章", "9"), ("b", "第", "1"), ("b", "第9章", "1"), ("b", "第1章", "x")], "book_id string, key string, value string")
    out, rejects = T.fix_entries(toc, fixes)
    assert [(r.page_num, r.is_roman) for r in out.orderBy("ord").collect()] == [(3, False), (9, False)]
    assert sorted((r.key, r.hits) for r in rejects.collect()) == [("第", 2), ("第1章", 1), ("第9章", 0)]


def test_offset(spark):
    toc = spark.createDataFrame([("b", 0, "大", "はじめに", 1, False), ("b", 1, "大", "第1章 時間とは――何か", 5, False)], TOC)
    pages = spark.createDataFrame([("b", p, "時間とは" if p in (6, 9) else "x") for p in range(1, 20)], "book_id string, page int, text string")
    n = spark.createDataFrame([("b", 19)], "book_id string, n_pages int")
    got = T.offset(toc, pages, spark.createDataFrame([("b", 6)], "book_id string, page int"), n).first()
    assert (got.target_page, got.needle, got.offset) == (5, "時間とは", 4)


BLOCK = "book_id string, seq int, kind string, level string, lines array<string>, page int"


def heads(spark, *rows):
    return spark.createDataFrame([("b", i, *r) for i, r in enumerate(rows)], BLOCK)


def test_chapters_and_navigation(spark):
    b = heads(
        spark, ("para", None, ["献辞"], 1), ("heading", "大", ["はじめに"], 2), ("heading", "大", ["第Ⅰ部", "題"], 3), ("heading", "大", ["第1章"], 4), ("heading", "中", ["1-1"], 4), ("heading", "小", ["x"], 5),
        ("heading", "大", ["第1章"], 6), ("para", None, ["y"], 6), ("heading", "大", ["参考文献"], 7), ("heading", "大", ["あとがき"], 8),
    )
    chapters, nav = H.split_chapters(b)
    assert [(r.chapter_no, r.section_type, r.id) for r in chapters.orderBy("seq").collect()] == [
        (0, "chapter", None), (1, "chapter", None), (2, "part", None), (3, "chapter", None), (3, "chapter", "h0001"), (3, "chapter", "h0002"), (3, "chapter", None), (4, "chapter", None), (5, "chapter", None),
    ]
    assert [(r.node_id, r.parent_id, r.depth, r.title, r.href) for r in nav.orderBy("node_id").collect()] == [
        (1, None, 1, "はじめに", "text/ch001.xhtml"), (2, None, 1, "第Ⅰ部　題", "text/ch002.xhtml"), (3, 2, 2, "第1章", "text/ch003.xhtml"), (4, 3, 3, "1-1", "text/ch003.xhtml#h0001"),
        (5, 2, 2, "参考文献", "text/ch004.xhtml"), (6, None, 1, "あとがき", "text/ch005.xhtml"),
    ]
    assert H.nav_depth(nav).first().depth == 3
    assert [r.play_order for r in H.play_order(nav).orderBy("node_id").collect()] == [1, 2, 3, 4, 5, 6]
    assert [(r.chapter_no, r.pages) for r in H.chapters_without_entry(chapters).collect()] == [(0, "p1")]
    spine = spark.createDataFrame([("b", f"text/ch00{k}.xhtml", p) for k, p in ((1, 0), (2, 1), (3, 5), (4, 4), (5, 6))], "book_id string, href string, pos int")
    assert [r.target for r in H.nav_order_problems(nav, spine).collect()] == ["text/ch004.xhtml"]


def test_false_part_headings(spark):
    long = ["長" * 101]
    b = heads(spark, ("heading", "大", ["第Ⅰ部"], 1), ("para", None, long, 1), ("heading", "大", ["第Ⅰ部"], 2), ("heading", "大", ["第Ⅱ部"], 3), ("para", None, long, 3))
    assert [r.kind for r in H.demote_part_headings(b).orderBy("seq").collect()] == ["para", "para", "heading", "heading", "para"]
    same = heads(spark, ("heading", "大", ["第Ⅰ部"], 1), ("heading", "大", ["第Ⅰ部"], 2), ("heading", "大", ["第Ⅱ部"], 3), ("para", None, long, 3))
    assert [r.kind for r in H.demote_part_headings(same).orderBy("seq").collect()] == ["heading", "heading", "para", "para"]
    lone = heads(spark, ("heading", "大", ["第Ⅰ部"], 1), ("para", None, long, 1))
    assert [r.kind for r in H.demote_part_headings(lone).orderBy("seq").collect()] == ["heading", "para"]
