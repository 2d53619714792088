import random
import re

import corpus_pipeline as pipeline
from quirewise.llm import queries


def test_stages_keep_clean_documents_and_take_effect(spark, tmp_path):
    rng = random.Random(4)
    clean = [(i, " ".join(f"the{rng.randrange(10**6):x}and" for _ in range(60)), "en", "s", 0) for i in range(30)]
    item = " ".join(f"quiz{j}ing" for j in range(25))
    passage = " ".join(f"shared{j}ness" for j in range(30))
    rows = clean + [
        (100, clean[0][1], "en", "s", 0), (101, clean[1][1].replace("and ", "and  ", 1) + " end", "en", "s", 0), (102, "12 34", "en", "s", 0), (103, None, "en", "s", 0),
        (104, f"{clean[2][1][::-1]} {item} tail", "en", "s", 0), (105, f"some first words {passage} here", "en", "s", 0), (106, f"{passage} other last words stand here alone", "en", "s", 0),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stages = dict(pipeline.STAGES)
    ids = lambda d: sorted(r.doc_id for r in d.select("doc_id").collect())
    out = stages["language_id"](spark, docs, str(tmp_path))
    assert out.columns == docs.columns and not {102, 103} & set(ids(out)) and set(range(30)) <= set(ids(out))
    out = stages["ngram_jaccard_join"](spark, docs, str(tmp_path))
    assert out.columns == docs.columns and set(ids(out)) == {r[0] for r in rows} - {100, 101}
    out = stages["substring_dedup"](spark, docs, str(tmp_path)).collect()
    kept = {r.doc_id: r.text for r in out}
    assert all(kept[i] == t for i, t, *_ in clean) and 100 not in kept and kept[106] == "other last words stand here alone" and kept[105] == rows[-2][1]
    assert next(r for r in out if r.doc_id == 106).n_chars == len(kept[106])
    out = stages["benchmark_decontamination"](spark, docs, str(tmp_path))
    assert out.columns == docs.columns and set(ids(out)) == {r[0] for r in rows} - {104}
    assert stages["piece_encoding"](spark, docs, str(tmp_path)).count() == len(rows)
    empty = docs.where("false")
    for _, stage in pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).collect() == []


def test_rows_with_null_or_repeated_ids_stay_apart(spark, tmp_path):
    rng = random.Random(5)
    a, b, c, d, e, f = (" ".join(f"the{rng.randrange(10**6):x}and" for _ in range(60)) for _ in range(6))
    item = " ".join(f"quiz{j}ing" for j in range(25))
    # b and c have a copy elsewhere; their ids are null or repeated, with a text that sorts before theirs.
    rows = [(None, a), (None, "a " + d), (None, b), (5, b), (7, c), (7, "a " + e), (9, c), (3, f), (3, f), (None, f"{f[::-1]} {item}"), (3, f"{e[::-1]} {item}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stages = dict(pipeline.STAGES)
    got = lambda frame: sorted(map(tuple, frame.collect()), key=repr)
    out = stages["ngram_jaccard_join"](spark, docs, str(tmp_path))
    assert got(out) == sorted((r for r in set(rows) if r not in {(5, b), (9, c)}), key=repr)
    out = stages["benchmark_decontamination"](spark, docs, str(tmp_path))
    assert got(out) == sorted(rows[:-2], key=repr)


def test_queries_have_no_row_limits():
    source = open(queries.__file__).read() + open(pipeline.__file__).read()
    assert not re.search(r"\.limit\(|\.sample\(|\.head\(", source)
