import json

from quirewise.streaming import ingest


def test_pages_come_once(spark, tmp_path):
    (tmp_path / "in/b").mkdir(parents=True)
    point = lambda x: {"points": [[x, 0], [x + 1, 0], [x + 1, 1], [x, 1]], "content": f"w{x}", "direction": "horizontal"}

    def put(name, page):
        body = {"page": page, "image_size": {"h": 9, "w": 9}, "words": [point(page), point(page + 50)], "paragraphs": [], "tables": [], "figures": []}
        (tmp_path / f"in/b/{name}.json").write_text(json.dumps(body))

    def go():
        stream = ingest.page_stream(spark, f"{tmp_path}/in")
        ingest.ingest_lines(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination(120)
        return sorted((r.page, r.ord, r.text) for r in spark.read.parquet(f"{tmp_path}/out").collect())

    put("p0001", 1)
    assert go() == [(1, 0, "w1"), (1, 1, "w51")]
    put("p0002", 2)
    put("p0001-again", 1)
    assert go() == [(1, 0, "w1"), (1, 1, "w51"), (2, 0, "w2"), (2, 1, "w52")]
