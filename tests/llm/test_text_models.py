from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import covered, empty, strange
from pyspark.sql import functions as F

from loomdex.llm import html_text, licenses, quality, queries, tiling, toxicity
from loomdex.llm.common import blocks, table


@pytest.mark.parametrize(("name", "label", "least"), [("op1_quality_classifier", "quality", 0.95), ("op4_toxicity", "toxic", 0.9)])
def test_held_out_accuracy(spark, name, label, least):
    folder = "/root/testdata/sf0.01"
    got = queries.QUERIES[name](spark, folder)
    assert got.count() == table(spark, folder, "documents").count()
    seen = got.join(table(spark, folder, "labels"), "doc_id").where("held_out")
    right = seen.select(F.avg((F.col("predicted") == F.col(label)).cast("double"))).first()[0]
    assert right >= least


@pytest.mark.parametrize("n", [1, 24, 25, 26, 700])
def test_votes_equal_those_over_all_neighbours_with_ties(n):
    """Every neighbour sorted by similarity and place, for vectors of whole numbers, of which many are equally near."""
    rng = np.random.default_rng(n)
    known = rng.integers(-2, 3, (n, 6)).astype(np.float32)
    labels = rng.integers(0, 2, n).astype(np.float64)
    asked = rng.integers(-2, 3, (600, 6)).astype(np.float32)
    got = quality.vote(asked, {"vectors": known, "labels": labels})
    for score, own in zip(got, asked):
        near = sorted((-float(own @ other), place) for place, other in enumerate(known))[: quality.NEIGHBOURS]
        weight = [np.exp(quality.SHARPNESS * (near[0][0] - similarity)) for similarity, _ in near]
        assert score == pytest.approx(sum(w * labels[place] for w, (_, place) in zip(weight, near)) / sum(weight), abs=1e-9)


def test_quality_that_lies_in_words_alone_is_learnt(spark):
    """Both kinds of text have words of the same letters' classes and lengths."""
    rng = np.random.default_rng(5)
    kinds = [["".join(chr(97 + c) for c in rng.integers(0, 26, 6)) for _ in range(60)] for _ in range(2)]
    rows = [(i, " ".join(rng.choice(kinds[i % 2], 80)) + ".", i % 2) for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int")
    model = quality.learn(docs, docs.where("doc_id < 600").select("doc_id", "label"))
    got = {r.doc_id: r.score for r in quality.score(docs.where("doc_id >= 600"), model).collect()}
    assert np.mean([(score >= 0.5) == doc % 2 for doc, score in got.items()]) >= 0.95


@pytest.mark.parametrize("model", [quality, toxicity])
def test_scores_of_strange_rows(spark, model):
    docs = strange(spark, "some plain words here")
    labels = spark.createDataFrame([(1, 1), (6, 0), (None, 1), (3, None), (99, 1)], "doc_id long, label int")
    got = model.score(docs, model.learn(docs, labels)).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    none = model.score(docs, model.learn(docs, labels.where("false"))).collect()
    assert {r.score for r in none} == {0.5}
    assert model.score(empty(spark), model.learn(empty(spark), labels)).count() == 0


def test_toxic_rows_keep_their_columns(spark):
    docs = strange(spark, "some plain words here")
    model = toxicity.learn(docs, docs.selectExpr("doc_id", "1 as label"))
    assert toxicity.scored_rows(docs, model).select("row.*").columns == docs.columns


def test_training_separates_and_is_sparse():
    rng = np.random.default_rng(0)
    rows = [(int(i % 3 == 0), np.unique(np.r_[rng.integers(10, 5000, 60), 1 if i % 3 == 0 else 2])) for i in range(600)]
    weights, bias = toxicity.train(rows)
    assert weights[1] > 0 > weights[2] and np.count_nonzero(weights) < 500
    assert all((weights[c].sum() + bias > 0) == bool(y) for y, c in rows)


def test_phrases_and_notices(spark):
    rows = [
        (1, "X MIT License, mit-license. The GNU general\npublic license"), (2, None), (3, "mit"), (4, "CC BY CC BY"),
        (5, "Licensed under the very Apache License, Version 2.0"), (6, "apache 2.0 license"), (6, "émit license"), (7, ""),
        (8, "CC BY CC BY"), (8, "CC BY CC BY"),
    ]
    got = licenses.licenses(spark.createDataFrame(rows, "doc_id long, text string")).drop("score")
    assert sorted(map(tuple, got.collect())) == sorted(
        [
            (1, 10, 3, 1, 6, "gpl,mit", "gpl,mit"), (2, 0, 0, None, None, "", ""), (3, 1, 0, None, None, "", ""), (4, 4, 2, 0, 2, "cc-by", "cc-by"),
            (5, 9, 1, 4, 4, "apache", "apache,apache-2.0"), (6, 4, 0, None, None, "", ""), (6, 2, 0, None, None, "", ""), (7, 0, 0, None, None, "", ""),
            (8, 4, 2, 0, 2, "cc-by", "cc-by"), (8, 4, 2, 0, 2, "cc-by", "cc-by"),
        ]
    )


def test_license_scan_has_no_python_and_takes_strange_rows(spark, capsys):
    docs = strange(spark, "all rights reserved")
    licenses.licenses(docs).explain()
    assert not any(x in capsys.readouterr().out for x in ("Python", "Arrow", "Pandas"))
    assert licenses.licenses(docs).count() == docs.count()
    assert licenses.licenses(empty(spark)).count() == 0


def test_tiles_are_longest_first_and_do_not_overlap():
    def codes(s):
        return np.array([ord(c) for c in s], np.uint64)

    assert tiling.tiles(codes("abcdefghij"), codes("fghijXabcde"), 3) == [(0, 6, 5), (5, 0, 5)]
    assert tiling.tiles(codes("abcabcabc"), codes("abcabc"), 3) == [(0, 0, 6)]
    assert tiling.tiles(codes("ab"), codes("ab"), 3) == []
    rng = np.random.default_rng(5)
    for _ in range(100):
        a, b = (rng.integers(0, 3, rng.integers(0, 40)).astype(np.uint64) for _ in range(2))
        used_a, used_b = np.zeros(len(a), int), np.zeros(len(b), int)
        for i, j, n in tiling.tiles(a, b, 3):
            assert n >= 3 and (a[i : i + n] == b[j : j + n]).all()
            used_a[i : i + n] += 1
            used_b[j : j + n] += 1
        assert used_a.max(initial=0) <= 1 and used_b.max(initial=0) <= 1
        free = {tuple(a[i : i + 3]) for i in range(len(a) - 2) if not used_a[i : i + 3].any()}
        assert not free & {tuple(b[j : j + 3]) for j in range(len(b) - 2) if not used_b[j : j + 3].any()}


def test_reordered_and_whole_passages_are_caught(spark, monkeypatch):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    turned = "eta theta iota kappa lambda mu and then alpha beta gamma delta epsilon zeta"
    docs = strange(spark, f"before {turned} after").union(
        spark.createDataFrame([(7, item.upper(), "g", 1), (8, "alpha beta gamma delta epsilon", "h", 1)], "doc_id long, text string, mark string, row int")
    )
    bench = spark.createDataFrame([(1, item), (2, None), (3, "too short"), (None, item), (4, "")], "item_id long, text string")
    for limit in (1 << 24, 30):  # one block, and a block for each item
        monkeypatch.setattr(tiling, "ITEMS", limit)
        got = tiling.contaminated(docs, bench)
        assert got.select("row.*").columns == docs.columns and got.count() == docs.count()
        hits = [(r.doc_id, r.m.item_id, r.m.n_covered) for r in got.select("row.doc_id", F.explode("matches").alias("m")).collect()]
        assert sorted(hits, key=str) == sorted([(1, 1, 12), (1, 1, 12), (None, 1, 12), (7, 1, 12)], key=str)
    assert tiling.contaminated(empty(spark), bench).count() == 0
    assert tiling.contaminated(docs, bench.where("false")).where("size(matches) > 0").count() == 0


def test_tiles_of_equal_words_take_time_by_their_runs():
    import time
    import tracemalloc

    ones = np.ones(20_000, np.uint64)
    broken = ones.copy()
    broken[::999] = 7
    tracemalloc.start()
    begun = time.monotonic()
    assert tiling.tiles(ones[:1000], ones) == [(0, 0, 1000)]
    assert sum(n for _, _, n in tiling.tiles(ones[:1000], broken)) == 998  # two words are left, too few for a tile
    assert time.monotonic() - begun < 10 and tracemalloc.get_traced_memory()[1] < 200 << 20
    tracemalloc.stop()


@pytest.mark.parametrize(("threshold", "sieve", "at_once"), [(0.5, 24, 256), (0.8, 8, 1), (0.2, 24, 3)])
def test_items_of_one_phrase_equal_brute_force(spark, monkeypatch, threshold, sieve, at_once):
    monkeypatch.setattr(tiling, "SIEVE", sieve)
    monkeypatch.setattr(tiling, "ITEMS", at_once)
    rng = np.random.default_rng(9)

    def some(n):
        return " ".join(rng.choice([f"w{i}" for i in range(60)], n))

    phrase = "which of the following is true about"  # in every item and most documents
    bench = [(i, f"{phrase} {some(rng.integers(0, 20))}") for i in range(30)] + [(3, "w1 w1 w1 w1 w1 w1 w1 w1"), (40, "w2 w2 w2 w2 w2")]
    rows = []
    for i in range(80):
        parts = [some(rng.integers(0, 10)), phrase if i % 4 else "", *(bench[k][1][rng.integers(0, 60) :] for k in rng.integers(0, 30, 2))]
        rows.append((i, " ".join(parts)))
    rows += [(100, "W1 " * 50), (101, "w2 " * 5), (5, rows[5][1]), (102, rows[5][1])]
    docs, items = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([*bench, bench[0]], "item_id long, text string")
    got = tiling.contaminated(docs, items, threshold).collect()
    assert len(got) == len(rows)
    want = Counter((doc, item) for doc, text in rows for item, own in bench for _ in covered(text, [(item, own)], share=threshold))
    found = Counter((r["row"].doc_id, m.item_id) for r in got for m in r.matches)
    assert found.keys() <= want.keys()  # tiles do not overlap in the text, seeds may
    words = {key: tiling.hashed_words(*next(blocks(pa.RecordBatch.from_arrays([pa.array([key])], names=["text"])))[2:])[0] for _, key in [*rows, *bench]}
    exact = Counter(
        (doc, item)
        for doc, text in rows
        for item, own in bench
        if covered(text, [(item, own)], share=threshold) and sum(n for _, _, n in tiling.tiles(words[own], words[text])) >= threshold * len(words[own])
    )
    assert found == exact and found


def test_contamination_of_whole_table_equals_brute_force(spark, data):
    import re

    def words(t):
        return re.findall(r"[0-9a-z\x80-\U0010ffff]+", t.lower())

    bench = [(r.item_id, words(r.text)) for r in table(spark, data, "benchmark").collect()]
    want = set()
    for r in table(spark, data, "documents").collect():
        own = words(r.text)
        grams = {tuple(own[i : i + 5]) for i in range(len(own) - 4)}
        for item, other in bench:
            covered = {j for i in range(len(other) - 4) if tuple(other[i : i + 5]) in grams for j in range(i, i + 5)}
            if len(covered) >= 0.5 * len(other):
                want.add((r.doc_id, item))
    got = queries.QUERIES["op10_benchmark_decontamination"](spark, data)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want


PAGE = (
    '<html><head><title>no</title></head><body><header class="top"><h1>Site</h1></header><div id="wrap"><div class="sidebar">links</div>'
    '<div class="story"><h2>T{0}</h2><p>Hello &lt;b&gt; &nbsp; w&ouml;rld {0} <i>it</i>alic<br>x<p>two{0}<ul><li>a{0}<li>b</ul>'
    '<div class="share-buttons">Share it</div><div class="box">Same words</div><form>q<input></form></div>'
    '<section class="comments"><p>nice {0}</section></div><footer>c</footer><script>var a="<p>s</p>";</script>'
)


def test_main_text_of_templates_and_odd_pages(spark):
    pages = [PAGE.format(i) for i in range(5)] + [None, "", "plain  text", "<p>a<p>b", "<article>only &amp; me</article><div>zz", PAGE.format(1)]
    rows = [(i, f"http://h.x/{i}" if i < 7 or i == 10 else None, p, "clash") for i, p in enumerate(pages)]
    got = {r.page_id: r for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, host string")).collect()}
    for i in range(5):
        assert got[i].text == f"T{i}\nHello <b> wörld {i} italic x\ntwo{i}\na{i}\nb"
    assert [got[i].text for i in range(5, 11)] == ["", "", "plain text", "a\nb", "only & me", got[1].text]
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_main_text_of_whole_table(spark, data):
    import html
    import re

    for row in queries.QUERIES["op6_html_extraction"](spark, data).join(table(spark, data, "pages").select("page_id", "html"), "page_id").collect():
        inner = re.search(r"<article>(.*?)</article>", row.html, re.S).group(1)
        parts = (re.sub(r"<[^>]*>", "", re.sub(r"<br>", " ", p)) for p in re.split(r"</?(?:p|h1)>", inner))
        want = [t for t in (re.sub(r"\s+", " ", html.unescape(p)).strip() for p in parts) if t]
        assert row.text == "\n".join(want)


@pytest.mark.parametrize("wrapper", [
    "<div class='page with-sidebar'><article>@</article></div>", "<main class='no-sidebar'>@</main>", "<div id='search-page'>@</div>",
    "<article class='post has-related comments-open'>@</article>", "<div class='comments-open sidebar'><main id='search'>@</main></div>",
])
def test_noise_words_of_whole_page_wrappers(wrapper):
    rest = "<div class='sidebar'>side</div><div class='comment-list'><article class='comment'>me too</article></div><nav>menu</nav>"
    page = "<html><body>" + wrapper.replace("@", f"<h1>Title</h1><p>{'long text ' * 20}</p><div class='ad-slot'>buy</div>") + rest + "</body></html>"
    assert html_text.main_text(page, None, frozenset()) == "Title\n" + ("long text " * 20).strip()


LONG = "long text " * 40
WHOLE = {
    "head beside a large division": (f"<article><h1>Title</h1><p>Lead</p><div class=story><p>{LONG}</p></div></article>", f"Title\nLead\n{LONG.strip()}"),
    "head beside an article": (f"<main><h1>Title</h1><p>Lead</p><article><p>{LONG}</p></article></main>", f"Title\nLead\n{LONG.strip()}"),
    "a form around the page": (f"<form id=aspnet><nav>menu</nav><article><p>{LONG}</p><form class=f>mail</form></article></form>", LONG.strip()),
    "a form around all text": (f"<form><div><p>{LONG}</p></div></form>", LONG.strip()),
    "a stray quote": ("<article><p>before <a title=it's>link</a> after</p><p>it's more</p></article>", "before link after\nit's more"),
    "a quote with a bracket": ("<article><p title='a > b'>one</p><p title = \"c > d's\">two</p></article>", "one\ntwo"),
    "a noise word within a name": ("<article><p>one</p><div class='share-price-table'>12</div><div class='share-buttons'>x</div></article>", "one\n12"),
    "names of noise": ("<article><p>one</p><div class='left-sidebar'>a</div><div id=comments-section>b</div><div class=ad_slot_2>c</div></article>", "one"),
    "no article": (f"<div class=page><div class=x><h1>T#</h1></div><div class=y><p>{LONG}</p></div></div><footer>f</footer>", f"T#\n{LONG.strip()}"),
}


@pytest.mark.parametrize("case", WHOLE)
def test_no_text_of_an_article_is_lost(spark, case):
    page, want = WHOLE[case]
    rows = [(i, f"http://h{i % 2 and i}.x/{i}", f"<html><body>{page.replace('#', str(i)).replace('long text', f'long text{i}', 1)}</body></html>") for i in range(8)]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    fixed = "long text" not in page
    assert {r.page_id: r.text for r in got if not (fixed and r.page_id % 2 == 0)} == {
        i: want.replace("#", str(i)).replace("long text", f"long text{i}", 1) for i in range(8) if not (fixed and i % 2 == 0)
    }


def test_text_of_copied_pages_stays(spark):
    page = "<html><body><nav>menu {1}</nav><article><h1>T{0}</h1><div class='lead'><p>lead {0} of it</p></div><div class='body'><p>body {0} of it all</p></div><div class='box'>Same words</div></article></body></html>"
    want = {}
    rows = []
    for host, numbers in (("two.x", [1, 1]), ("many.x", [1, 1, 1, 1, 2, 3, 4]), ("hot.x", [5] * 30)):
        for n, i in enumerate(numbers):
            want[len(rows)] = f"T{i}\nlead {i} of it\nbody {i} of it all" + "\nSame words" * (host != "many.x")
            rows.append((len(rows), f"http://{host}/{n}", page.format(i, n % 2)))
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == want
