"""Pages to written packages and texts."""

import io
import json
import zipfile

from quirewise.plans.run import publish_books
from quirewise.sources import pages as S
from tests.test_layout import page, para, word


def test_pages_become_a_checked_package_and_a_text(spark, tmp_path):
    given = [
        page(1, [word(100, 100, 500, 130, "第1章 起"), word(100, 200, 500, 230, "本文の一行目です"), word(100, 240, 500, 270, "二行目です。")], [para((90, 90, 510, 140), "第1章 起", 0, "section_headings"), para((90, 190, 510, 280), order=1)]),
        page(2, [word(100, 100, 500, 130, "目次"), word(100, 200, 500, 230, "起3")], [para((90, 90, 510, 140), "目次", 0, "section_headings"), para((90, 190, 510, 240), order=1)]),
    ]
    (tmp_path / "in").mkdir()
    for p in given:
        (tmp_path / "in" / f"p{p['page']:04d}.json").write_text(json.dumps(p, ensure_ascii=False))
    layer = spark.createDataFrame([], "book_id string, page int, layer string")
    books = spark.createDataFrame([("b", "題 & 名", "甲", None, "urn:uuid:1", "2000-01-01T00:00:00Z"), ("none", "t", "", "", "urn:uuid:2", "2000-01-01T00:00:00Z")], "book_id string, title string, author string, publisher string, identifier string, modified string")
    out = tmp_path / "out"
    problems = publish_books(S.read_pages(spark, str(tmp_path / "in"), "b"), layer, books, str(out))
    assert problems.collect() == []
    assert sorted(f.name for f in out.iterdir()) == ["b.epub", "b.txt"]
    text = (out / "b.txt").read_text(encoding="utf-8")
    assert "第1章" in text and "本文の一行目です二行目です。" in text and "目次" not in text
    with zipfile.ZipFile(io.BytesIO((out / "b.epub").read_bytes())) as z:
        assert z.namelist()[0] == "mimetype" and "OEBPS/text/ch000.xhtml" in z.namelist()
        assert "本文の一行目です二行目です。" in z.read("OEBPS/text/ch000.xhtml").decode()
