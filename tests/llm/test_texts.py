"""Operators 3, 4, 6, 7, 8 and 9 against libraries, held-out rows and goldens."""

import hashlib
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quirewise.llm import html_text, languages, licences, pieces, queries, token_counts, toxicity

FOLDER = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")
needs_model = pytest.mark.skipif(not os.path.exists(queries.PIECE_MODEL), reason="no tokenizer here")
ODD = ["", None, " ", "   ", " a", "a ", "a  b", "▁", "▁▁ x", "a\n b\n\n c", "\t", "a\x00b", "🙂🙂  é", "ｆｕ　 ll", "x " * 500, "� z", "</s> <unk> <0x0A>", "same", "same"]


@needs_model
def test_pieces_are_the_librarys(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)
    frame = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(ODD)], "doc_id long, text string, n_tokens string")
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for r in pieces.encode_decode(frame, queries.PIECE_MODEL, table_rows=5).collect():
        ids = library.encode(ODD[r.doc_id] or "", add_eos=True)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids)))
    assert pieces.encode_decode(frame.where("false"), queries.PIECE_MODEL).collect() == []


@needs_model
def test_long_texts_go_in_parts(monkeypatch):
    import sentencepiece

    monkeypatch.setattr(pieces, "PART", 50)
    library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)
    text = " ".join(f"word{i}  é🙂" for i in range(200)) + " "
    ids = library.encode(text, add_eos=True)
    n, digest, _ = pieces.ChunkTable(queries.PIECE_MODEL).row(text, library.eos_id())
    assert (n, digest) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())


def test_viterbi_against_a_library_and_all_paths():
    from tokenizers import Tokenizer, models

    vocabulary = {"a": -1.0, "b": -2.0, "ab": -3.0, "▁": -1.5, "▁a": -2.5, "ba": -3.0, "aba": -3.0, "é": -2.0}
    ours = token_counts.CountOnlyViterbi(vocabulary)
    both = [("<unk>", 0.0), *((f"<0x{i:02X}>", 0.0) for i in range(256)), *vocabulary.items()]
    library = Tokenizer(models.Unigram(both, 0, True))
    for text in ("▁ab", "▁abab", "▁aabba", "▁xab", "▁é日", "▁", "▁abaaba"):
        assert ours.count(text)[0] == len(library.encode(text, add_special_tokens=False).ids), text
    assert ours.count("▁日x") == (5, 4)


@needs_model
def test_token_counts_of_odd_texts(spark):
    frame = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    viterbi = token_counts.CountOnlyViterbi(token_counts.unigram_vocabulary(queries.PIECE_MODEL))
    got = {r.doc_id: (r.n_tokens, r.n_unknown) for r in token_counts.count_tokens(frame, queries.PIECE_MODEL, table_rows=3).collect()}
    for i, t in enumerate(ODD):
        assert got[i] == (viterbi.count("▁" + t.replace(" ", "▁")) if t else (0, 0))


@needs_data
def test_languages_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = queries.op3_language_id(spark, FOLDER).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.95
    assert all(0 <= r.score <= 1 for r in got) and {r.lang_pred for r in got} <= {"en", "de", "fr", "es"}


def test_languages_special_cases(spark):
    rows = [(i, w * 20, l, 1) for i, (w, l) in enumerate([("der hund und ", "de"), ("the dog and ", "en")] * 10)]
    odd = [(100, None, "en", 1), (101, "", "en", 1), (102, "12 !?", "en", 1), (103, "日本", None, 1), (104, "the", None, 1), (104, "the", None, 1)]
    frame = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, score int")
    filters = languages.learn(frame, min_rate=1e-4)
    got = {r.doc_id: (r.lang_pred, r.score) for r in languages.identify(frame.drop("lang"), filters).collect()}
    assert got[100] == got[101] == got[102] == ("und", 0.0) and got[103][0] in ("de", "en") and got[103][1] == 0.0 and got[104][0] == "en"
    assert all(got[i][0] == l for i, _, l, _ in rows)
    nothing = languages.identify(frame, languages.learn(frame.where("false")))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}
    assert languages.identify(frame.where("false"), filters).collect() == []


def test_grams_are_counted_once_over_parts(monkeypatch):
    grams = languages.Grams()
    text = "ein hund und eine katze, zwei Vögel " * 8 + "日本語" * 60
    whole = sorted(grams.of([text])[1].tolist())
    monkeypatch.setattr(languages, "PART", 64)
    split = sorted(grams.of([text])[1].tolist())
    assert whole == split and len(list(grams.stretches([text, "x"]))) > 3


def test_bloom_masks_hold_all_languages():
    import numpy as np

    rng = np.random.default_rng(2)
    grams = [rng.integers(0, 2**63, 500).astype(np.uint64) for _ in range(70)]
    filters = languages.LanguageFilters.build({f"l{k:02}": (g, 500) for k, g in enumerate(grams)})
    for k, g in enumerate(grams):
        assert ((filters.masks(g)[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)).all()
    assert filters.false_rate.max() < 0.1


@needs_data
def test_toxicity_on_held_out_rows(spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    got = queries.op7_toxicity(spark, FOLDER).join(labels, "doc_id").where("held_out").select("score", "predicted", "toxic").toPandas()
    rank, n1 = got["score"].rank(), int(got["toxic"].sum())
    auc = (rank[got["toxic"] == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(got) - n1))
    assert auc > 0.9 and ((got["score"] >= 0.7) == (got["predicted"] == 1)).all()


def test_toxicity_of_identity_terms_and_special_cases(spark):
    bad, good = ["you stupid women", "stupid muslim people", "stupid scum", "what a stupid fool"], ["nice day here", "lovely garden", "the market opens at nine", "men walk home"]
    texts = [t for t in bad + good for _ in range(12)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(900, None), (901, ""), (902, "women met here"), (903, "muslim families met here")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(t in bad)) for i, t in enumerate(texts)] + [(950, 1), (0, None)], "doc_id long, toxic int")
    model = toxicity.learn(labels, docs)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert got[0] > 0.7 and got[902] < 0.5 and got[903] < 0.5 and got[900] == got[901]
    # Swapped copies of the labelled texts: without their penalty the score hangs on the term.
    gap = lambda m: max(abs(a - b) for a, b in zip(*(m.scores(pa.array(t)) for t in (["stupid women talk", "muslim people"], ["stupid girls talk", "hindu people"]))))
    free = toxicity.learn(labels, docs, strength=0.0)
    assert gap(model) < 0.5 * gap(free) and gap(free) > 0.02, (gap(model), gap(free))
    assert toxicity.swapped("The Gay and muslim_x, women!") == ["the lesbian and christian_x, men!", "the straight and jewish_x, girls!"] and toxicity.swapped("womens") == []
    one = toxicity.learn(labels.where("toxic = 0"), docs)
    assert {r.predicted for r in toxicity.score(docs, one).collect()} == {0}
    assert toxicity.score(docs.where("false"), toxicity.learn(labels.where("false"), docs)).collect() == []


@needs_data
def test_licences_on_the_tables(spark):
    known = {"MIT": "Released under the MIT License.", "GPL": "GNU General Public License, version 3.", "Apache-2.0": "Licensed under the Apache License, Version 2.0.", "CC-BY-NC": "Licensed under CC BY-NC 4.0."}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("n", "line"))
    want = {(r.doc_id, r.n + 1, k) for k, t in known.items() for r in lines.where(F.col("line").contains(t)).collect()}
    got = {(r.doc_id, r.paragraph, r.family) for r in queries.op6_licence_scan(spark, FOLDER).where("confirmed").collect() if r.family in known}
    assert got == want and want


def test_licences_special_cases(spark):
    rows = [(1, None), (2, ""), (3, "\n\nAll rights reserved.\nbla"), (4, "some words of a story\nthe public house"), (4, "Released under the MIT License.")]
    frame = spark.createDataFrame(rows, "doc_id int, text string")
    got = sorted((r.doc_id, r.paragraph, r.family) for r in licences.scan(frame, licences.learn(frame)).collect() if r.confirmed)
    assert got == [(3, 3, "All-rights-reserved"), (4, 1, "MIT")]
    assert licences.scan(frame.where("false"), licences.train([])).collect() == []


@needs_data
def test_main_text_of_the_pages(spark):
    import html
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    for r in queries.op9_main_text(spark, FOLDER).collect():
        article = re.search("<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        blocks = re.split(r"</?(?:p|h\d|br)[^>]*>", article)
        want = " ".join(filter(None, (" ".join(html.unescape(re.sub("</?b>", "", b)).split()) for b in blocks)))
        assert r.text == want and r.n_chars == len(want)


PAGE = """<html><head><title>t</title></head><body class="has-sidebar"><header>Site</header><div class="content"><h1>Title here</h1>
<p>First  paragraph that is long enough to be the text of this page, <a href=#>link</a>&nbsp;more&hellip;</p><div class="ad-box">Buy</div><p>Short.</p>
<p>Third paragraph with words enough to count as text on this page &amp; so on.</p></div><section id="comments"><p>A reader writes a comment that is long enough to look like text of the page.</p></section>
<div class="cookie-notice">We use cookies</div><form><label>Name</label></form><aside>Side</aside><footer>foot</footer><script>var x = "<p>no</p>";</script></body>"""


def test_main_text_goldens(spark):
    want = "Title here First paragraph that is long enough to be the text of this page, link more… Short. Third paragraph with words enough to count as text on this page & so on."
    odd = [PAGE, "", None, "<nav>only</nav>", "plain text", "<article><p>One<p>two<b>bold</b> x<article class='comment'>no</article></article><p>out", "<p>a < b &lt;c&gt;</p>", "<aside>x<article>in</article>"]
    frame = spark.createDataFrame([(i, "u", h, "clash") for i, h in enumerate(odd)], "page_id int, url string, html string, text string")
    got = [r.text for r in html_text.extract(frame).orderBy("page_id").collect()]
    assert got == [want, "", "", "", "plain text", "One twobold x", "a < b <c>", "in"]
    assert html_text.extract(frame.where("false")).collect() == []


def test_main_text_weighs_text_outside_of_articles():
    body = "<h1>Title</h1>" + "".join(f"<p>Paragraph {k} of the body, long enough to be the text of this page by its weight alone.</p>" for k in range(6))
    want = " ".join(["Title", *(f"Paragraph {k} of the body, long enough to be the text of this page by its weight alone." for k in range(6))])
    teaser = "<article><h3>Other</h3><p>A teaser.</p></article>"
    for furniture in (f"<aside class=related>{teaser}</aside>", f"<footer>{teaser}</footer>", f"<nav><div>{teaser}</div></nav>", f"<div class=sidebar>{teaser}</div>"):
        for page in (f"<div>{body}</div>{furniture}", f"{furniture}<div>{body}</div>", f"<article>{body}</article>{furniture}", f"<div>Site name</div><main>{body}</main>{furniture}<div>Made by us</div>"):
            assert html_text.main_text(f"<body>{page}</body>") == want, page
    assert html_text.main_text(f"<div class='page sidebar-right'><article>{body}</article></div>") == want
    assert html_text.main_text(f"<div>{body}</div><article><p>A teaser.</p></article>") == f"{want} A teaser."
    assert html_text.main_text(f"<nav>menu<article>{body}</article>") == want


def test_main_text_keeps_what_names_and_links_do_not_make_furniture():
    long = "A paragraph that is long enough to be the text of this page by its weight alone, and some more words."
    body = f"<h2 id='related-work'>Related work</h2><p>{long}</p><h2 id='search-algorithms'>Search</h2><p id=notice>{long}</p><section id='social-policy'><h3>Policy</h3><p>{long}</p></section>"
    want = f"Related work {long} Search {long} Policy {long}"
    for page in (f"<article>{body}</article>", f"<div>{body}</div>", f"<article>{body}<div class='share-buttons'>Share</div><div id=comments>Me too</div></article>"):
        assert html_text.main_text(page) == want
    linked = f"<p>{long}</p><p><a href=#>All of this line is a link</a></p><p>{long}</p><p><a href=#>Next</a></p>"
    assert html_text.main_text(f"<div><p><a href=#>Home</a></p>{linked}</div>") == f"{long} All of this line is a link {long}"


def test_licences_over_lines_and_of_two_families(spark):
    import textwrap

    notices = {k: max(licences.TEMPLATES[k], key=len) for k in ("MIT", "GPL", "BSD", "ISC", "Apache-2.0")}
    rows = [(i, "A story.\n\n" + "\n".join(f"# {x}" for x in textwrap.wrap(t, 72))) for i, t in enumerate(notices.values())]
    rows += [(9, "Licensed under the Apache License, Version 2.0 or the MIT License."), (10, "word " * 300 + "\n" + "\n".join(["some more words of a story"] * 40))]
    frame = spark.createDataFrame(rows, "doc_id int, text string")
    got = sorted((r.doc_id, r.paragraph, r.family) for r in licences.scan(frame, licences.train([])).collect() if r.confirmed)
    assert got == [*((i, 3, k) for i, k in enumerate(notices)), (9, 1, "Apache-2.0"), (9, 1, "MIT")]


def test_main_text_of_odd_markup_and_names():
    story = "".join(f"<p>Paragraph {k} of the body, long enough to be the text of this page by its weight alone.</p>" for k in range(4))
    want = " ".join(f"Paragraph {k} of the body, long enough to be the text of this page by its weight alone." for k in range(4))
    assert html_text.main_text("<p title=it's>Hello there</p><p>I don't <b>know</b> it.</p>") == "Hello there I don't know it."
    assert html_text.main_text(f"<body><div class='main sidebar-right'>{story}</div></body>") == want
    extra = "<div class='related-work'><p>Related things</p></div><div id='search-results'>Found</div>"
    comments = "<section><h2>2 Comments</h2><p>A reader writes a comment that is long enough to look like text of the page.</p></section>"
    assert html_text.main_text(f"<article>{story}{extra}{comments}</article>") == f"{want} Related things Found"
    assert html_text.main_text(f"<div>{story}</div>{comments}") == want
    assert html_text.main_text(f"<div>{story}</div><p class=ad>Buy<p>The end of it.") == f"{want} The end of it."
    assert html_text.main_text(f"<form id=aspnet>{story}</form>") == want


def test_main_text_windows_decide():
    long = "A paragraph that is long enough to be the text of this page by its weight alone, and some more words."
    page = f"<div>Site name</div><ul><li><a href=#>a</a><li><a href=#>b</a><li><a href=#>c</a></ul><div><p>{long}</p><p><a href=#>One link</a></p><p>{long}</p></div>"
    assert html_text.main_text(page) == f"{long} One link {long}"
    assert html_text.main_text(page, window=1) == f"{long} {long}"  # without windows a link line is a dive
    marked = "<div><p>Made by us</p></div><article><h1>T</h1>" + f"<p>{long}</p>" * 3 + "</article><div>" + f"<p>{long}</p>" * 2 + "</div>"
    assert html_text.main_text(marked) == " ".join(["T", *[long] * 5])  # long text outside of a mark counts, a short line doesn't


@pytest.mark.parametrize("page", ["<a y " * 200_000, "<a b='x " * 100_000, "'\"" * 500_000, "<div></p>" * 50_000, "<p " + "/" * 1_000_000 + ">x", "<!--" + "<!-- x" * 150_000, "<a b=\">\" " * 100_000, "<h2>Comments</h2><p>x</p>" * 20_000, "<nav>a<article>b" * 20_000, "<" * 300_000])
def test_malformed_pages_take_linear_time(page):
    import time

    began = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - began < 4


def test_licences_outside_of_the_list_are_unknown():
    model = licences.train(["some words of a story here and there"] * 200)
    told = lambda t: [(model.families[k], s >= licences.CONFIRM) for k, s in zip(*(x.tolist() for x in model.scan(pa.array([t]))[1::2]))]
    for text in ("Licensed under the Eclipse Public License 2.0.", "Licensed under the Artistic License 2.0.", "he went to MIT with a license"):
        assert not any(sure for _, sure in told(text)), text
    for text, family in (("MIT License", "MIT"), ("License: GPLv2", "GPL"), ("Licensed under the Mozilla Public License, version 2.0.", "MPL-2.0"), ("Licensed under the GNU Lesser General Public License, version 2.1.", "LGPL")):
        assert told(text) == [(family, True)], text
