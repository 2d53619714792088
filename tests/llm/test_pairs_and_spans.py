"""Operators 1, 2, 5 and 10 against brute force on small, awkward inputs."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quirewise.llm import components, decontamination, fingerprints, ngram_join, substrings

SPLIT = re.compile("[\x20\x09-\x0d]+")
DOC = "doc_id long, text string, score string, doc string, _key string"


def words(text):
    return [w for w in SPLIT.split(text or "") if w]


def shingles(text, n=5):
    w = words(text)
    return frozenset(tuple(w[i : i + n]) for i in range(max(len(w) - n + 1, 1))) if w else frozenset()


@pytest.fixture(scope="module")
def rows():
    """Copies, near copies, shared passages, empty, short, null and long texts, odd spaces, repeated rows."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)] + ["é", "日本", "🙂"]
    base = [" ".join(rng.choices(vocabulary, k=rng.choice([3, 25, 60, 200]))) for _ in range(60)]
    texts = list(base)
    for t in base[:20]:
        texts += [t] * rng.choice([0, 1, 5])
        w = t.split(" ")
        for _ in range(rng.choice([0, 2, 6])):
            v = list(w)
            v[rng.randrange(len(v))] = "edit"
            texts.append(" ".join(v))
    passage = " ".join(rng.choices(vocabulary, k=30))
    texts += [f"{rng.choice(base)} {passage} {rng.choice(base)}" for _ in range(10)]
    texts += ["", None, " ", "one", "one", "a b c d", "a\tb\nc  d", "x\n\n" * 300, " ".join(rng.choices(vocabulary, k=6000)), f"\n{passage}\n"]
    rng.shuffle(texts)
    return [(i * 3 + 1, t, "s", "d", "k") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOC).repartition(5)


def test_ngram_join_against_brute_force(docs, rows):
    sets = {i: shingles(t) for i, t, *_ in rows}
    near = {i: {j for j, t in sets.items() if j != i and s and t and len(s & t) / len(s | t) >= 0.8} for i, s in sets.items()}
    root = {}
    for i in sorted(sets):
        todo = [i] if i not in root else []
        for j in todo:
            if j not in root:
                root[j] = i
                todo += near[j]
    copy = {i: min(j for j, t, *_ in rows if (t or "") == (text or "") and words(t)) if words(text) else i for i, text, *_ in rows}
    got = {r.doc_id: r for r in ngram_join.join(docs, block=4).collect()}
    assert {i: r.n_links for i, r in got.items()} == {i: len(n) for i, n in near.items()}
    assert {i: r.class_id for i, r in got.items()} == root
    assert {i: r.copy_id for i, r in got.items()} == copy


def test_hot_prefixes_stay_long_where_other_tries_make_up_for_them():
    def own(hot, sizes):
        rows = [{"key": 1, "node": 1, "text_hash": 1, "tree": t, "label": b"x", "bytes": 1, "n4": sizes(t), "n5": 900, "n6": 800} for t in range(hot)]
        batch = pa.RecordBatch.from_pylist(rows)
        out = pa.Table.from_batches(ngram_join.shortening(16, 6, 4, 0.8, 0.999)(iter([batch])))
        assert list(out["lengths"][0].as_py())[:hot] == out["own"].to_pylist()
        missed = 1.0
        for length in out["lengths"][0].as_py():
            missed *= 1 - 0.8**length
        assert missed <= 0.001
        return out["own"].to_pylist()

    assert own(5, lambda t: 1000) == [6] * 5
    whole = own(16, lambda t: 1000 + 1000 * t)
    assert 4 <= min(whole) and max(whole) > 4
    assert whole[0] < whole[-1]  # those that gain the fewest nodes go first


@pytest.mark.parametrize("block", [16, 256])
def test_hot_group_of_near_copies_keeps_each_link(spark, block):
    rng = random.Random(8)
    base = [f"v{rng.randrange(10**6)}" for _ in range(120)]
    texts = []
    for i in range(150):
        w = list(base)
        for k in range(i % 4):
            w[rng.randrange(120)] = f"e{i}-{k}"
        texts.append(" ".join(w))
    sets = [shingles(t) for t in texts]
    want = [sum(len(a & b) / len(a | b) >= 0.8 for j, b in enumerate(sets) if j != i) for i, a in enumerate(sets)]
    frame = spark.createDataFrame([(i, t, "s", "d", "k") for i, t in enumerate(texts)], DOC)
    got = {r.doc_id: r.n_links for r in ngram_join.join(frame, block=block).collect()}
    assert sum(got.values()) >= 0.998 * sum(want)
    assert all(got[i] <= n for i, n in enumerate(want))


def test_ngram_join_repeats_nulls_and_empty(spark):
    text = " ".join(map(str, range(40)))
    frame = spark.createDataFrame([(None, text), (5, text), (5, text), (7, "other words"), (7, text + " x")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.class_id, r.n_links) for r in ngram_join.join(frame).collect())
    assert len(got) == 5 and got[0] == (0, None, 3)
    assert [c for _, c, _ in got[:3]] == [None] * 3
    assert ngram_join.join(frame.where("false")).collect() == []
    assert ngram_join.prefix_depth(0.8, 16, 6, 0.999) == 4 and ngram_join.prefix_depth(0.5, 2, 4, 0.999) == 1


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 30)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 31)} | {100: 100} | {k: 100 for k in range(101, 140)}


def brute_windows(rows, size=20):
    first, out = {}, {}
    for i, text, *_ in sorted(rows):
        w = words(text)
        gone = set()
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            if first.setdefault(key, (i, k)) < (i, k):
                gone.update(range(k, k + size))
        out[i] = (len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest())
    return out


def test_substrings_against_brute_force(docs, rows):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substrings.dedup_substrings(docs).collect()}
    assert got == brute_windows(rows)


def test_substrings_special_cases(spark):
    text = " ".join(map(str, range(30)))
    frame = spark.createDataFrame([(2, text, "a"), (2, text, "b"), (None, text, "c"), (3, f"{text} {text}", "d"), (4, None, "e")], "doc_id long, text string, kept_text string")
    got = substrings.dedup_substrings(frame, keep=("doc_id", "kept_text")).orderBy("kept_text").collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in got) == [(0, 30, 0), (2, 30, 30), (2, 30, 30), (3, 60, 60), (4, 0, 0)]
    assert substrings.dedup_substrings(frame.where("false")).collect() == []


ITEM = "the quick brown fox jumps over the lazy dog while seven wizards quietly box five more jugs of liquid"


def test_decontamination_against_brute_force(spark):
    w = ITEM.split()
    texts = [ITEM, f"a b c {ITEM} d", " ".join(["x", *w[:-1], "y"]), " ".join(w[:9] + ["z"] + w[10:]), "nothing here at all to see", "", None, " ".join(w[1:]), f"{ITEM} and {ITEM}", "so one two three go", "one two"]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, start int")
    items = spark.createDataFrame([(7, ITEM), (8, "one two three"), (9, None), (9, "")], "item_id long, text string")
    want = set()
    for i, t in enumerate(texts):
        d = words(t)
        for item, body in ((7, w), (8, ["one", "two", "three"])):
            n, size = min(len(body), len(d)), 5 if len(body) >= 5 else len(body)
            bag = lambda x: Counter(tuple(x[k : k + size]) for k in range(len(x) - size + 1))  # noqa: B023, E731
            both = [(bag(d[k : k + n]), bag(body)) for k in range(len(d) - n + 1)] if n >= size else []
            if any(sum((a & b).values()) / sum((a | b).values()) >= 0.8 for a, b in both):
                want.add((i, item))
    got = decontamination.find(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    assert [(r.start_word, r.n_words, r.similarity) for r in got if r.doc_id == 1] == [(3, 19, 1.0)]
    assert sorted(r.start_word for r in got if r.doc_id == 8) == [0, 20]
    parts = decontamination.find(docs, items, part_items=1).collect()  # a benchmark over the bound goes in parts
    assert {(r.doc_id, r.item_id) for r in parts} == want
    assert decontamination.find(docs, items.where("false")).collect() == [] and decontamination.find(docs.where("false"), items).collect() == []


def test_hamming_blocks_return_all_within_the_radius():
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(1)
    index = decontamination.ItemIndex(np.arange(50), pa.array([" ".join(map(str, rng.integers(0, 99, 30))) for _ in range(50)]))
    prints = index.prints.copy()
    for k in range(50):  # flip up to the radius, and one more
        for b in rng.choice(64, decontamination.RADIUS + (k % 2), replace=False):
            prints[k, b // 8] ^= 1 << (b % 8)
    window, item = index.candidates(prints)
    found = set(zip(window.tolist(), item.tolist()))
    distance = lambda a, b: int(np.unpackbits(a ^ b).sum())
    assert found == {(k, i) for k in range(50) for i in range(50) if distance(prints[k], index.prints[i]) <= decontamination.RADIUS}


def test_fingerprints_against_brute_force(docs, rows):
    got = {r.doc_id: r for r in fingerprints.fingerprint(docs).collect()}
    order = sorted(((i, t or "") for i, t, *_ in rows), reverse=True)
    jaccard = lambda a, b: len(a & b) / len(a | b) if a or b else 1.0
    for k, (i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        close = 1e-9 if max(map(len, map(shingles, (t, edited, after)))) < 100 else 0.15
        assert abs(r.near_edited - jaccard(shingles(t), shingles(edited))) <= close
        assert abs(r.near_next - jaccard(shingles(t), shingles(after))) <= close


def test_sketches_merge_and_estimate(spark):
    rng = random.Random(3)
    a, b = [" ".join(str(rng.randrange(10**6)) for _ in range(3000)) for _ in range(2)]
    frame = spark.createDataFrame([(f"{a} {b}", a, b, "", None)], "ab string, a string, b string, e string, n string")
    s = {c: fingerprints.sketch(F.col(c)) for c in frame.columns}
    r = frame.select(
        fingerprints.resemblance(s["ab"], s["a"]).alias("half"), fingerprints.containment(s["a"], s["ab"]).alias("inside"), fingerprints.distinct_shingles(s["ab"]).alias("n"),
        fingerprints.resemblance(fingerprints.merge(s["a"], s["b"]), s["ab"]).alias("merged"), fingerprints.resemblance(s["e"], s["n"]).alias("empty"), fingerprints.resemblance(s["e"], s["a"]).alias("none"),
    ).first()
    assert abs(r.half - 0.5) < 0.12 and r.inside > 0.85 and abs(r.n - 5996) < 1200 and r.merged > 0.97 and (r.empty, r.none) == (1.0, 0.0)
    parts = spark.createDataFrame([("k", a), ("k", b), ("j", a)], "key string, text string").withColumn("sketch", fingerprints.sketch(F.col("text")))
    merged = {x.key: x.sketch for x in fingerprints.merge_groups(parts, ["key"]).collect()}
    assert merged["k"] == frame.select(fingerprints.merge(s["a"], s["b"]).alias("m")).first().m


def test_fingerprints_special_cases(spark):
    frame = spark.createDataFrame([(None, "ab"), (3, "cdef"), (3, "cdef"), (9, None)], "doc_id long, text string")
    got = fingerprints.fingerprint(frame).collect()
    assert len(got) == 4 and sum(r.doc_id is None for r in got) == 1
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sorted(r.edited_sha256 for r in got) == sorted(map(digest, ["a", "cdcd", "cdab", ""]))
    assert fingerprints.fingerprint(frame.where("false")).collect() == []
    lone = fingerprints.fingerprint(spark.createDataFrame([(1, "xy")], "doc_id long, text string")).first()
    assert lone.near_next == 1.0 and lone.edited_sha256 == digest("xx")


def test_the_radius_of_the_index_decides_candidates():
    import numpy as np
    import pyarrow as pa

    from quirewise.llm import kernels

    rng = random.Random(8)
    items = [[f"i{rng.randrange(500)}" for _ in range(60)] for _ in range(40)]
    texts = [" ".join(["before", *w[:20], "edit", *w[21:], "after"]) for w in items]
    found = lambda radius: {m[:2] for m in decontamination.ItemIndex(np.arange(40), pa.array([" ".join(w) for w in items]), radius=radius).matches(kernels.Words(pa.array(texts)))}
    assert found(decontamination.RADIUS) == {(k, k) for k in range(40)} and len(found(0)) < 20
