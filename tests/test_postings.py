"""The inverted index against plain scores, and statistics that merge."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomdex.functions.embedding import sparse_dot
from loomdex.operators import corpus, postings, retrieval, statistics


def vectors(seed, n, width, most, low=0.0):
    r = random.Random(seed)
    out = []
    for i in range(n):
        idx = sorted(r.sample(range(width), r.randint(0, most)))
        if i % 3:
            idx = sorted({0, *idx})  # one entry that most have
        out.append((i, (idx, [round(r.uniform(low, 3), 2) if j else 0.1 for j in idx])))
    return out


SPARSE = "struct<indices:array<int>,values:array<double>>"


def plain_topk(points, queries, k, zeros):
    out = set()
    for qid, (qi, qv) in queries:
        asked = dict(zip(qi, qv))
        scored = [(round(sum(v * asked.get(i, 0) for i, v in zip(*p)), 9) + 0.0, pid) for pid, p in points]
        best = sorted(((-s, pid) for s, pid in scored if zeros or s), key=lambda x: x)[:k]
        out |= {(qid, pid, round(-s, 6) + 0.0, rank) for rank, (s, pid) in enumerate(best, 1)}
    return out


@pytest.mark.parametrize(("zeros", "shard_rows", "low"), [(True, 1 << 16, 0.0), (False, 90, 0.0), (True, 60, -1.0), (False, 40, -1.0)])
def test_index_gives_the_best_of_all(spark, zeros, shard_rows, low):
    points, queries = vectors(1, 500, 60, 9, low), vectors(2, 30, 70, 6)
    queries += [(90, ([], [])), (91, ([69], [1.0])), (92, ([0], [1.0]))]
    index = postings.build_postings(spark.createDataFrame(points, f"id long, text_sparse {SPARSE}"), shard_rows=shard_rows)
    asked = spark.createDataFrame(queries, f"qid long, text_sparse {SPARSE}")
    got = postings.sparse_topk_postings(index, asked, 7, zeros).collect()
    assert {(r.qid, r.id, round(r.score, 6) + 0.0, r.rank) for r in got} == plain_topk(points, queries, 7, zeros)


def test_index_equals_the_scan_of_arrays(spark, data):
    words = corpus.with_tokens(spark.read.parquet(f"{data}/documents.parquet").select(F.col("doc_id").alias("id"), "text"))
    asked = spark.read.parquet(f"{data}/benchmark.parquet").select(F.col("item_id").alias("qid"), "text")
    entries = corpus.vocabulary_entries(corpus.build_vocabulary(words, "id"))
    want = retrieval.sparse_topk(corpus.sparse_vector(words, entries), corpus.sparse_query_vector(asked, entries), 10)
    index = postings.build_postings(corpus.sparse_vector(words, entries, dense=False), shard_rows=50)
    got = postings.sparse_topk_postings(index, corpus.sparse_query_vector(asked, entries, dense=False), 10)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count() > 0


def test_pruning_leaves_most_of_a_common_word_out():
    n = 20_000
    common = (np.arange(n, dtype=np.int32), np.full(n, 0.1), np.full(-(-n // postings.BLOCK), 0.1))
    rare = (np.arange(0, n, 100, dtype=np.int32), np.full(n // 100, 5.0), np.full(2, 5.0))
    shard = postings._Shard.__new__(postings._Shard)
    shard.lists, shard.ids, shard.total = {0: common, 1: rare}, pa.array(range(n)), np.zeros(n)
    position, score, work = shard.best([(0, 1.0), (1, 1.0)], 10, -np.inf, True, 9)
    assert position.tolist() == list(range(0, 1000, 100)) and set(score) == {5.1}
    assert work == 2 * len(rare[0])  # of 20,000 entries of the common word, those of the rare one's documents
    assert not shard.total.any()


def test_no_documents_and_no_queries(spark):
    none = spark.createDataFrame([], f"id string, text_sparse {SPARSE}")
    asked = spark.createDataFrame([(1, ([0], [1.0]))], f"qid long, text_sparse {SPARSE}")
    index = postings.build_postings(none)
    assert postings.sparse_topk_postings(index, asked, 3).count() == 0
    some = postings.build_postings(spark.createDataFrame([("b", ([], [])), ("a", None)], none.schema))
    assert [r.id for r in postings.sparse_topk_postings(some, asked, 3).orderBy("rank").collect()] == ["a", "b"]
    assert postings.sparse_topk_postings(some, asked.where("false"), 3).count() == 0


def test_sparse_dot_merges_indices(spark):
    rows = [(([1, 4, 9], [1.0, 2.0, 3.0]), ([4, 9, 11], [5.0, 7.0, 1.0])), (([], []), ([1], [1.0])), (([2], [3.0]), ([2], [-1.0]))]
    df = spark.createDataFrame(rows, f"a {SPARSE}, b {SPARSE}")
    assert [r[0] for r in df.select(sparse_dot("a", "b")).collect()] == [31.0, 0.0, -3.0]


def test_pairs_and_arrays_hold_the_same_weights(spark):
    df = spark.createDataFrame([(1, ["a", "x", "a", "c"]), (2, []), (3, None), (4, ["c"])], "id int, tokens array<string>")
    entries = [("c", 3.0), ("", 0.0), ("a", 2.0)]
    got = {r.id: (r.text_sparse.indices, r.text_sparse["values"]) for r in corpus.sparse_vector(df, entries, dense=False).collect()}
    assert got == {1: ([0, 2], [3.0, 2.0]), 2: ([], []), 3: ([], []), 4: ([0], [3.0])}


TEXTS = ["b a a c", "a b", "", "c a z", "a"]


@pytest.mark.parametrize("key", ["id", "name"])
def test_states_merge_to_the_state_of_all(spark, key):
    rows = corpus.with_tokens(spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")).withColumn("name", F.format_string("%03d", "id"))
    whole = statistics.token_state(rows, key)
    parts = [statistics.token_state(rows.where(f"id % 2 = {i}"), key) for i in (0, 1)]

    def shown(df):
        return {r.token: (r.n, r.df, r["first"].key, r["first"].pos) for r in df.collect()}

    assert shown(statistics.merged_states(*parts)) == shown(whole)
    name = (lambda i: f"{i:03d}") if key == "name" else int
    assert shown(whole) == {
        None: (5, 5, None, 0), "a": (5, 4, name(0), 1), "b": (2, 2, name(0), 0), "c": (2, 2, name(0), 3), "z": (1, 1, name(3), 2),
    }
    assert rows.select(statistics.documents_of(whole)).first()[0] == 5
