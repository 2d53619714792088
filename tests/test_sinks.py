"""Files that are written, and read again."""

import json
import os

import pytest

from quirewise.sources import pages, sinks


@pytest.mark.parametrize("uri", [True, False])
def test_texts_and_packages(spark, tmp_path, uri):
    folder = tmp_path.as_uri() if uri else str(tmp_path)
    frame = spark.createDataFrame([("a", "一\n二", bytearray(b"\x00z")), ("b", "", bytearray())], "book_id string, text string, epub binary").repartition(2)
    for _ in range(2):  # a second run puts the same files in place
        sinks.write_texts(frame, folder)
        sinks.write_packages(frame, folder)
    assert sorted(os.listdir(tmp_path)) == ["a.epub", "a.txt", "b.epub", "b.txt"]
    assert (tmp_path / "a.txt").read_text(encoding="utf-8") == "一\n二" and (tmp_path / "a.epub").read_bytes() == b"\x00z"
    assert (tmp_path / "b.txt").read_bytes() == b""


def test_fixes_are_read_as_written(spark, tmp_path):
    rows = [("a", 1, 3, "x\"y", "z", None), ("a", 0, 2, "あ", "", "w"), ("b", 0, None, "p", "q", "r")]
    sinks.write_fixes(spark.createDataFrame(rows, "book_id string, ord int, page int, before string, after string, why string"), str(tmp_path))
    assert [f["page"] for f in json.loads((tmp_path / "a.json").read_text(encoding="utf-8"))] == [2, 3]
    got = [tuple(r) for r in pages.read_fixes(spark, f"{tmp_path}/a.json", "a").orderBy("ord").collect()]
    assert got == sorted(r for r in rows if r[0] == "a")


def test_log(spark, tmp_path):
    rows = [("a", 4, "x|y", "z", True, "typo", None), ("a", 2, "p", "q", False, None, "not found"), ("a", 1, "m", "n", True, None, None)]
    sinks.write_log(spark.createDataFrame(rows, "book_id string, line_no int, before string, after string, ok boolean, why string, reason string"), str(tmp_path))
    lines = (tmp_path / "a.md").read_text(encoding="utf-8").split("\n")
    assert lines[0] == "## applied (2)" and lines[4:6] == ["| 1 | m | n |  |", "| 4 | x\\|y | z | typo |"]
    assert "## rejected (1)" in lines and "| 2 | p | q | not found |" in lines
