"""Rows that only larger tables have, and batches that are worked off in parts of bounded size."""

import numpy as np
import pyarrow as pa

from loomdex.catalog import QUERIES
from loomdex.functions import embedding
from loomdex.functions.embedding import list_parts
from loomdex.operators import postings, statistics


def test_pages_of_one_motion_may_share_address_and_text(spark, tmp_path):
    rows = [(2, "u", "<p>one</p>"), (42, "u", "<p>one</p>"), (10, "a", "<p>one</p>"), (3, "b", "<p>two</p>"), (82, "u", "<p> one </p>")]
    rows += [(3, "b", "<p>two</p>"), (None, None, None)]  # a page that comes twice, and nothing
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = [tuple(r) for r in QUERIES["extract_dedup_shared"](spark, str(tmp_path)).select("motion_id", "url", "status").collect()]
    firsts = [r for r in got if r[2] == "success"]
    assert len(got) == 14 and sorted(firsts) == [("2", "u", "success"), ("3", "b", "success")]
    assert sum(r[2] == "duplicate" for r in got) == 10


def test_parts_of_a_batch_are_bounded_and_whole():
    lists = pa.array([["a"] * n if n is not None else None for n in (3, 0, None, 2, 9, 1, 1, 1, 1)])
    parts = list(list_parts(lists, 3, 5))
    assert [a for a, _ in parts] == [0, *[b for _, b in parts[:-1]]] and parts[-1][1] == len(lists)
    for a, b in parts:
        assert b - a <= 3 and (b - a == 1 or sum(len(x or []) for x in lists[a:b].to_pylist()) <= 5)
    assert not list(list_parts(pa.array([], pa.list_(pa.string()))))


def test_token_state_is_the_same_in_small_parts(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(None if n == 5 else n % 40, [f"w{w}" for w in rng.integers(0, 30, n % 13)] if n % 7 else None) for n in range(200)]
    df = spark.createDataFrame(rows, "id long, tokens array<string>")

    def state():
        return sorted(((r.token, r.n, r.df, r.first) for r in statistics.token_state(df, "id").collect()), key=lambda r: r[0] or "")

    whole = state()
    monkeypatch.setattr(statistics, "list_parts", lambda lists: list_parts(lists, None, 20))
    monkeypatch.setattr(statistics, "HELD_ROWS", 25)
    assert state() == whole and sum(n for t, n, *_ in whole if t) == sum(len(t or []) for _, t in rows)


def test_vectors_are_the_same_in_small_parts(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(n, None if n % 17 == 3 else [f"w{w}" for w in rng.integers(0, 50, n % 11)]) for n in range(120)]
    df = spark.createDataFrame(rows, "id long, tokens array<string>").coalesce(1)
    names, weights = [f"w{n}" if n != 4 else "" for n in range(40)], [n / 7 for n in range(40)]
    columns = [embedding.hash_embedding("tokens", 32), embedding.vocabulary_weights("tokens", names, weights), embedding.vocabulary_pairs("tokens", names, weights)]

    def vectors():
        return df.select("id", *[c.alias(f"c{k}") for k, c in enumerate(columns)]).orderBy("id").collect()

    whole = vectors()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert vectors() == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for r, (_, tokens) in zip(whole, rows):
        have = sorted({int(t[1:]) for t in tokens or []} & set(range(40)) - {4})
        assert r.c2.indices == have and [w for w in r.c1 if w] == [n / 7 for n in have if n]


def test_shards_are_bounded_in_entries(spark):
    points = spark.range(300).selectExpr("id", "struct(array(0, 1, 2) as indices, array(1D, 2D, id / 3) as values) as text_sparse")
    index = postings.build_postings(points, shard_entries=100).cache()
    assert index.where("idx = -1").count() >= 8 and index.selectExpr("explode(ids)").distinct().count() == 300
