import random

import numpy as np
import pytest
from helpers import brute_bytes, brute_words, classes_by_brute_force, empty, patchwork, rows_of, strange

from loomdex.llm import minhash, seed_extend, suffix_dedup
from loomdex.llm.bwt import repeated_starts
from loomdex.llm.common import table
from loomdex.llm.components import components


def test_interval_expansion_finds_exactly_the_repeated_strings():
    rng = np.random.default_rng(1)
    for _ in range(150):
        least, letters = int(rng.integers(2, 12)), int(rng.integers(1, 5))
        texts = [rng.integers(1, letters + 1, rng.integers(1, 60)).astype(np.uint8) for _ in range(rng.integers(1, 6))]
        symbols = np.concatenate([np.r_[t, 0] for t in texts]).astype(np.uint8)
        room = np.concatenate([np.r_[np.arange(len(t), 0, -1), 0] for t in texts])
        at = [bytes(symbols[i : i + least]) if room[i] >= least else None for i in range(len(symbols))]
        want = [x is not None and at.count(x) > 1 for x in at]
        assert repeated_starts(symbols, room, least).tolist() == want


@pytest.mark.parametrize("group", [2000, 1])
def test_byte_repeats_equal_brute_force(spark, group):
    r = random.Random(3)
    parts = ["".join(r.choice("abé ") for _ in range(r.randint(5, 120))) for _ in range(30)]
    rows = [*patchwork(3, parts, "abcdef", 150, ["", " "]), (500, "ab" * 300), (501, "ab" * 100), (502, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_dedup.remove_repeats(docs, 60, gram=16, group=group, transform=3000)
    assert rows_of(got) == brute_bytes(rows, 60)


def test_byte_repeats_of_one_anchor_in_very_many_segments(spark, monkeypatch, tmp_path):
    """A passage whose edges differ from text to text: repeats are exact, and few windows become rows."""
    r = random.Random(6)
    other = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    passage, ends = other(150), [other(3) for _ in range(4)]
    rows = [(i, other(60) + r.choice(ends) + passage[r.randint(0, 5) :] + r.choice(ends) + other(60)) for i in range(200)]
    rows += [(500 + i, other(40) + passage[: r.randint(60, 150)] + other(40)) for i in range(60)] + rows[:5]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    made = f"{tmp_path}/made"
    plain = suffix_dedup._windows

    def counted(least):
        work = plain(least)

        def run(batches):
            for batch in work(batches):
                with open(made, "a") as file:
                    file.write(f"{batch.num_rows}\n")
                yield batch

        return run

    monkeypatch.setattr(suffix_dedup, "_windows", counted)
    got = suffix_dedup.remove_repeats(docs, 100, gram=16, group=10)
    assert rows_of(got) == brute_bytes(rows, 100)
    with open(made) as file:
        windows = sum(map(int, file))
    segments = suffix_dedup.segments(suffix_dedup.keyed(docs), 100, 16)
    in_all = segments.groupBy("anchor", "content").agg({"windows": "max"}).groupBy("anchor").agg(
        {"max(windows)": "sum", "content": "count"}
    ).where("`count(content)` > 10").agg({"sum(max(windows))": "sum"}).first()[0]
    assert 0 < windows < 0.6 * in_all


@pytest.mark.parametrize("stretch", [1, 5, 1000])
def test_byte_repeats_by_stretches_of_any_width(spark, monkeypatch, stretch):
    monkeypatch.setattr(suffix_dedup, "STRETCH", stretch)
    r = random.Random(stretch)
    parts = ["".join(r.choice("ab") for _ in range(r.randint(5, 60))) for _ in range(12)]
    rows = patchwork(stretch, parts, "ab", 120, ["", " "])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(suffix_dedup.remove_repeats(docs, 24, gram=8, group=1)) == brute_bytes(rows, 24)


def test_byte_repeats_of_whole_table_equal_brute_force(spark, data):
    docs = table(spark, data, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert rows_of(suffix_dedup.remove_repeats(docs)) == brute_bytes(rows, 400)


def test_texts_without_repeats_keep_columns_and_rows(spark):
    docs = strange(spark, "The quick brown fox. " * 40)
    got = suffix_dedup.without_repeats(docs)
    assert got.columns == docs.columns and got.count() == docs.count()
    assert {r.doc_id: r.text for r in got.where("doc_id in (3, 6)").collect()}.keys() == {3, 6}
    kept = suffix_dedup.remove_repeats(docs, with_text=True).selectExpr("doc_id", "decode(kept, 'utf-8') as text").collect()
    assert sorted(x.text or "" for x in kept) == sorted(r.text or "" for r in got.collect())


@pytest.mark.parametrize(("group", "pairs"), [(20_000, 64), (20_000, 1), (1, 1)])
def test_word_repeats_equal_brute_force(spark, group, pairs):
    r = random.Random(4)
    parts = [" ".join(r.choice(["a", "b", "c", "é", "dd", "e,", "F"]) for _ in range(r.randint(2, 25))) for _ in range(30)]
    rows = [*patchwork(4, parts, "abcdef ", 200, ["\n", "\t"]), (500, "ab " * 300), (501, "ab " * 100), (502, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = seed_extend.remove_repeats(docs, 12, gram=3, group=group, pairs=pairs)
    assert rows_of(got) == brute_words(rows, 12)


def test_word_repeats_of_whole_table_equal_brute_force(spark, data):
    docs = table(spark, data, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert rows_of(seed_extend.remove_repeats(docs)) == brute_words(rows, 50)


@pytest.mark.parametrize("remove", [lambda d: suffix_dedup.remove_repeats(d, with_text=True), lambda d: seed_extend.remove_repeats(d, with_text=True)])
def test_repeats_of_strange_rows(spark, remove):
    docs = strange(spark, "one two three four five six seven eight nine ten " * 20)
    got = remove(docs).collect()
    assert len(got) == docs.count()
    kept = {r.doc_id: r.kept if isinstance(r.kept, str) else bytes(r.kept or b"").decode() for r in got if r.doc_id in (2, 3, 4)}
    assert kept[2] == kept[3] == "" and kept[4] == "!!! ???"
    assert remove(empty(spark)).count() == 0


def near_copies(n):
    r = random.Random(9)
    base = [f"w{r.randint(0, 400)}" for _ in range(120)]
    texts = []
    for i in range(n):
        words = list(base)
        for _ in range(r.randint(0, 3)):
            words[r.randrange(len(words))] = f"x{r.randint(0, 9999)}"
        texts.append(" ".join(words))
    return texts + [" ".join(f"y{r.randint(0, 10**6)}" for _ in range(80)) for _ in range(40)]


@pytest.mark.parametrize(("small", "large"), [(12, 500), (2, 5), (2, 40)])
def test_classes_equal_brute_force(spark, monkeypatch, small, large):
    monkeypatch.setattr(minhash, "SMALL", small)
    monkeypatch.setattr(minhash, "LARGE", large)
    rows = list(enumerate(near_copies(60)))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    have: dict = {}
    for r in got:
        have.setdefault(r.class_id, []).append(r.doc_id)
    assert {frozenset(v) for v in have.values()} == classes_by_brute_force(rows)
    assert all(r.class_size == len(have[r.class_id]) and r.class_id == min(have[r.class_id]) for r in got)


def test_planted_pairs_of_one_template_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(minhash, "SMALL", 2)
    monkeypatch.setattr(minhash, "LARGE", 6)
    monkeypatch.setattr(minhash, "GRID", 20)
    r = random.Random(12)
    base = [f"w{i}" for i in range(140)]
    texts = [" ".join(base + [f"u{r.randrange(10**6)}" for _ in range(40)]) for _ in range(300)]
    planted = [t.rsplit(" ", 12)[0] + " " + " ".join(f"v{r.randrange(10**6)}" for _ in range(12)) for t in texts[::6]]
    lighter = [texts[i].rsplit(" ", 14)[0] for i in (3, 9, 15)]
    rows = list(enumerate([*texts, *planted, *lighter, " ".join(base), " ".join(base[:130])]))
    r.shuffle(rows)
    have: dict = {}
    for x in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        have.setdefault(x.class_id, []).append(x.doc_id)
    want = {frozenset(rows[i][0] for i in v) for v in classes_by_brute_force(rows)}
    assert sum(len(v) == 2 for v in want) > 40 and {frozenset(v) for v in have.values()} == want


def test_classes_of_whole_table_equal_brute_force(spark, data):
    rows = [tuple(r) for r in table(spark, data, "documents").orderBy("doc_id").select("doc_id", "text").collect()]
    have: dict = {}
    for r in minhash.near_duplicates(table(spark, data, "documents")).collect():
        have.setdefault(r.class_id, []).append(r.doc_id)
    assert {frozenset(v) for v in have.values()} == {frozenset(rows[i][0] for i in v) for v in classes_by_brute_force(rows)}


def test_classes_of_strange_rows(spark):
    docs = strange(spark, "one two three four five six seven eight")
    got = minhash.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    assert {(r.class_id, r.class_size) for r in got if r.doc_id == 1} == {(1, 2)}
    assert all(r.class_size == 1 for r in got if r.doc_id in (2, 3, 4))
    twins = spark.createDataFrame([(None, "a b c d e f"), (9, "A b, c d e f"), (8, "a b c d e f")], "doc_id long, text string")
    assert [r.doc_id for r in minhash.first_of_class(twins).collect()] == [8]
    kept = minhash.first_of_class(docs)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 1
    assert minhash.near_duplicates(empty(spark)).count() == 0


def test_weighted_samples_agree_as_often_as_sets_are_similar():
    rng = np.random.default_rng(2)
    code = np.arange(1, 401, dtype=np.uint64) * np.uint64(99991)
    a, b = rng.uniform(0.5, 3, 400), rng.uniform(0.5, 3, 400)
    both = [minhash.weighted_samples(code, w, np.array([0]), 4000)[:, 0] for w in (a, b)]
    assert abs((both[0] == both[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.03


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 20)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201), (200, 201)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert all(got[i] == 1 for i in range(1, 21)) and all(got[100 + i] == 100 for i in range(30)) and got[201] == 200
