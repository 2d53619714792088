import json
import random
from pathlib import Path
from urllib.parse import urlparse
from urllib.request import url2pathname

import pytest

from quirewise.operators import layout as L
from quirewise.plans import blocks as B
from quirewise.sources import pages as S


def word(x0, y0, x1, y1, text, vertical=False):
    return {"points": [[x0, y0], [x1, y0], [x1, y1], [x0, y1]], "content": text, "direction": "vertical" if vertical else "horizontal"}


def para(box, contents="", order=0, role=None, direction="horizontal"):
    return {"box": [float(v) for v in box], "contents": contents, "direction": direction, "order": order, "role": role}


def page(n, words, paragraphs=(), tables=(), figures=(), h=1000, w=600):
    return {"page": n, "image_size": {"h": h, "w": w}, "words": words, "paragraphs": list(paragraphs), "tables": list(tables), "figures": list(figures)}


@pytest.fixture
def book(spark, tmp_path):
    def load(*pages):
        for p in pages:
            (tmp_path / f"p{p['page']:04d}.json").write_text(json.dumps(p, ensure_ascii=False))
        return S.read_pages(spark, str(tmp_path), "b")

    return load


@pytest.fixture
def blocks(spark, book):
    def build(*pages, **more):
        layer = spark.createDataFrame([], "book_id string, page int, layer string")
        out, stats = B.build_blocks(book(*pages), layer, **more)
        return [(r.kind, r.level, r.page, r.lines if r.lines is not None else r.text) for r in out.orderBy("seq").collect()], stats.first()

    return build


def test_paragraphs_over_pages_headers_and_titles(spark, blocks):
    got, stats = blocks(
        page(1, [word(100, 100, 500, 130, "はじめに203")], [para((90, 90, 510, 140), role="page_header")]),
        page(2, [word(100, 200, 500, 230, "本文の一行目です"), word(100, 240, 500, 270, "三行目20"), word(100, 20, 300, 40, "はじめに")], [para((90, 10, 310, 50), role="page_header"), para((90, 190, 510, 320), order=1)]),
        page(3, [word(100, 200, 500, 230, "15年の続き。"), word(130, 240, 500, 270, "新しい段落。")], [para((90, 190, 510, 320), order=1)], figures=[{"box": [0.0, 400.0, 10.0, 410.0], "order": 3, "paragraphs": [{"contents": "ラベル"}]}]),
        page(4, [word(300, 100, 330, 130, "第"), word(340, 100, 370, 130, "1"), word(380, 100, 410, 130, "章"), word(100, 200, 500, 230, "題名")]),
        page(5, [word(100, 100, 400, 130, "漢字の本文です"), word(100, 150, 400, 180, "二行目"), word(100, 200, 400, 230, "三行目"), word(100, 85, 185, 100, "かんじ")], [para((90, 80, 510, 240), order=1)]),
    )
    assert got == [
        ("heading", "大", 1, ["はじめに"]),
        ("para", None, 2, ["本文の一行目です", "三行目20", "15年の続き。"]),
        ("para", None, 3, ["新しい段落。"]),
        ("figure", None, 3, None),
        ("heading", "大", 4, ["第1章", "題名"]),
        ("para", None, 5, ["｜漢字《かんじ》の本文です", "二行目", "三行目"]),
    ]
    assert (stats.ruby, stats.removed) == (1, 1)


def test_layout_part_and_contents_fallback(spark, blocks):
    layout = spark.createDataFrame([("b", 1)], "book_id string, page int")
    got, _ = blocks(
        page(1, [word(100, 100, 200, 130, "目次"), word(100, 200, 300, 230, "第1章"), word(350, 205, 500, 235, "7")]),
        page(2, [word(100, 100, 200, 130, "第lI部"), word(100, 140, 200, 170, "題")]),
        page(3, [], [para((0, 200, 500, 300), "一行\n二行", 0), para((0, 400, 500, 430), "図 1 説明", 1)]),
        layout=layout,
    )
    assert got == [("heading", "大", 1, ["目次"]), ("raw", None, 1, "第1章"), ("raw", None, 1, "7"), ("heading", "大", 2, ["第Ⅱ部", "題"]), ("para", None, 3, ["一行", "二行"]), ("raw", None, 3, "図1説明")]


def test_texts_are_written_once(spark, blocks):
    """The tables in between hold each text once; a paragraph goes on over pages whose lines aren't indented."""
    r = random.Random(1)
    texts = [[f"{r.getrandbits(3200):x}" for _ in range(50)] for _ in range(40)]
    root = Path(url2pathname(urlparse(spark.conf.get("spark.checkpoint.dir")).path))
    had = set(root.iterdir()) if root.exists() else set()
    got, stats = blocks(*(page(n, [word(130 if n % 10 == 1 and k == 0 else 100, 40 * k, 500, 40 * k + 30, t) for k, t in enumerate(ts)], [para((90, 0, 510, 2100))], h=3000) for n, ts in enumerate(texts, 1)))
    assert got == [("para", None, n + 1, sum(texts[n : n + 10], [])) for n in range(0, 40, 10)] and (stats.ruby, stats.removed) == (0, 0)
    size = sum(f.stat().st_size for new in set(root.iterdir()) - had for f in new.rglob("*.parquet"))
    assert size < 2 * sum(len(t) for ts in texts for t in ts)


def test_vertical_ruby_and_order(spark, book):
    lines = L.build_lines(book(page(1, [word(500, 100, 530, 500, "天体の運行", True), word(532, 100, 545, 260, "てんたい", True), word(440, 100, 470, 500, "二行目", True), word(380, 100, 410, 500, "三行目", True)])))
    marked = L.reading_order(L.attach_ruby(lines)).orderBy("rank")
    assert [r.text for r in marked.collect()] == ["｜天体《てんたい》の運行", "二行目", "三行目"]


def test_split_ruby_is_one(spark, book):
    lines = L.build_lines(book(page(1, [word(100, 100, 400, 130, "超越論的哲学の本"), word(100, 84, 150, 98, "ちょう"), word(160, 84, 210, 98, "えつ"), word(100, 200, 400, 230, "二"), word(100, 300, 400, 330, "三")])))
    assert "｜超越論《ちょうえつ》的哲学の本" in [r.text for r in L.attach_ruby(lines).collect()]


def test_base_span_edges():
    assert L.base_of("の漢字", 0, 30, 0, 30, "かんじ") == (1, 3)
    assert L.base_of("かなだけ", 0, 40, 0, 40, "ふり") == (3, 4)
    assert L.base_of("AB漢", 0, 20, 10, 20, "カン") == (2, 3)
    assert L.base_of("本", 0, 10, 50, 60, "ほん") == (0, 1)


def test_two_columns_and_row_clustering(spark, book):
    left = [word(40, 100 + 40 * k, 260, 130 + 40 * k, f"l{k}") for k in range(5)]
    right = [word(340, 100 + 40 * k, 560, 130 + 40 * k, f"r{k}") for k in range(5)]
    pages = book(page(1, left + right))
    sizes = pages.selectExpr("book_id", "page", "image_size.w as width", "image_size.h as height")
    rows = L.rows_of(L.build_lines(pages), sizes).orderBy("row").collect()
    assert [r.row_text for r in rows] == [f"l{k}" for k in range(5)] + [f"r{k}" for k in range(5)]


def test_part_numbers_by_text_layer(spark, book):
    lines = L.build_lines(book(page(1, [word(0, 0, 9, 9, "第1部と第lI部"), word(0, 20, 9, 29, "第3部")])))
    layer = spark.createDataFrame([("b", 1, "第I部 第III部 第3部")], "book_id string, page int, layer string")
    assert [r.text for r in L.fix_part_numerals(lines, layer).orderBy("ord").collect()] == ["第Ⅰ部と第Ⅲ部", "第Ⅲ部"]


def test_broken_page_fails(spark, tmp_path):
    (tmp_path / "p0001.json").write_text("{")
    with pytest.raises(Exception):
        S.read_pages(spark, str(tmp_path), "b").collect()


def test_sources(spark, tmp_path):
    (tmp_path / "fixes.json").write_text('[{"page": 1, "before": "a", "after": "b", "why": "w"}, {"page": 2, "before": "c"}]')
    assert [(r.ord, r.page, r.before, r.after) for r in S.read_fixes(spark, str(tmp_path / "fixes.json"), "b").orderBy("ord").collect()] == [(0, 1, "a", "b"), (1, 2, "c", None)]
    (tmp_path / "t.txt").write_text("a\n\nb")
    assert [(r.line_no, r.line) for r in S.read_text_lines(spark, str(tmp_path / "t.txt")).orderBy("line_no").collect()] == [(1, "a"), (2, ""), (3, "b")]
    have = spark.createDataFrame([(2,)], "page int")
    assert sorted(r.page for r in S.missing_pages(spark, (0, 9), 4, have).collect()) == [1, 3, 4]
    assert S.missing_pages(spark, (1, 4), 4, have, overwrite=True).count() == 4
