"""Each carrier query against its SQL on the smallest tables."""

import os

import pytest

from quirewise.plans.carriers import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def sql():
    import duckdb

    if not os.path.isdir(FOLDER):
        pytest.skip("no tables here")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    frame = QUERIES[name](spark, FOLDER)
    names = sorted(frame.columns)
    got = sorted(repr(tuple(r[c] for c in names)) for r in frame.collect())
    if name in ORACLES:
        found = sql.sql(ORACLES[name])
        columns = list(found.columns)
        assert sorted(columns) == names
        assert got == sorted(repr(tuple(r[columns.index(c)] for c in names)) for r in found.fetchall())
    elif name == "package_check":
        assert got == []
    else:
        assert got


def test_toc_numbers_reads_all_lines(spark, tmp_path):
    n = {1: 40, 2: 13, 3: 5}
    spark.createDataFrame([(d, "\n".join(["x"] * k)) for d, k in n.items()], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r.book_id, r.ord, r.title) for r in QUERIES["toc_numbers"](spark, str(tmp_path)).collect())
    assert got == [(d, j + 1, f"第{i + 1}章") for d, k in n.items() for j, i in enumerate(i for i in range(k) if i % 3 != 2)]


def test_fix_apply_ordered_judges_whole_texts(spark, tmp_path):
    texts = ["alpha " + "word " * 20 + "alpha", "beta " + "word " * 20, "gamma " + "word " * 20]
    spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r.ord, r.line_id, r.reason) for r in QUERIES["fix_apply_ordered"](spark, str(tmp_path)).collect())
    assert [(o, i) for o, i, _ in got] == [(1, None), (2, 1), (3, 2)] and got[0][2] == "not found"
