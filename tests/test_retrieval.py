import numpy as np
import pytest
from pyspark.sql import functions as F

from loomdex.functions.embedding import pack_vector, unpack_vector
from loomdex.operators import retrieval, scan
from loomdex.functions.vectors import cosine_similarity, int8_decode, int8_encode, unit_vector

N, Q, DIM = 400, 7, 24


def unit(m):
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, n, out=np.zeros_like(m), where=n > 0)


@pytest.fixture(scope="module")
def arrays():
    rng = np.random.default_rng(5)
    points = rng.integers(-3, 4, size=(N, DIM)).astype(float)
    points[50] = 0
    points[100:140] = points[7]  # exact ties
    sparse = np.where(rng.random((N, 10)) < 0.1, rng.integers(1, 4, size=(N, 10)), 0).astype(float)
    queries = rng.integers(-3, 4, size=(Q, DIM)).astype(float)
    queries[0] = points[7]
    wanted = (rng.random((Q, 10)) < 0.2).astype(float)
    wanted[1] = 0
    return points, sparse, queries, wanted


@pytest.fixture(scope="module", params=["long", "string"])
def tables(request, spark, arrays):
    points, sparse, queries, wanted = arrays
    name = (lambda i: f"p{i:05d}") if request.param == "string" else int
    ids = spark.createDataFrame(
        [(name(i), points[i].tolist(), sparse[i].tolist()) for i in range(N)],
        f"id {request.param}, text_dense array<float>, text_sparse array<double>",
    ).repartition(5)
    asked = spark.createDataFrame(
        [(i, queries[i].tolist(), wanted[i].tolist()) for i in range(Q)],
        "qid long, text_dense array<float>, text_sparse array<double>",
    )
    return ids, asked, name


def best(scores, k, within=None):
    """Per query the (id, score) of the top k, ties by id."""
    out = []
    for q in range(scores.shape[1]):
        rows = range(len(scores)) if within is None else within[q]
        ranked = sorted(rows, key=lambda i: (-round(scores[i, q], 9), i))[:k]
        out.append([(i, round(float(scores[i, q]), 9)) for i in ranked])
    return out


def result(df, name):
    got = {}
    for r in df.orderBy("qid", "rank").collect():
        got.setdefault(r.qid, []).append((r.id, round(r.score, 9) + 0.0, r.rank))
    return {q: v for q, v in got.items()}


def expected(lists, name):
    return {
        q: [(name(i), s + 0.0, n) for n, (i, s) in enumerate(rows, 1)] for q, rows in enumerate(lists) if rows
    }


@pytest.mark.parametrize("k", [1, 10, 60, 1000])
@pytest.mark.parametrize("prefix", [None, 8])
def test_dense_topk_is_exact(tables, arrays, k, prefix):
    points, asked, name = tables
    p, q = arrays[0][:, :prefix], arrays[2][:, :prefix]
    want = expected(best(unit(p) @ unit(q).T, k), name)
    assert result(retrieval.dense_topk(points, asked, k, prefix), name) == want


def test_packed_vectors_give_the_same_rows(tables):
    points, asked, name = tables
    packed = points.select("id", pack_vector("text_dense").alias("text_dense"), pack_vector("text_sparse", "double").alias("text_sparse"))
    for search in (retrieval.dense_topk, retrieval.sparse_topk):
        assert result(search(packed, asked, 10), name) == result(search(points, asked, 10), name)
    back = packed.select("id", unpack_vector("text_dense").alias("text_dense"), unpack_vector("text_sparse", "double").alias("text_sparse"))
    assert back.exceptAll(points).count() == 0


def test_packing_keeps_nulls_and_empty_vectors(spark):
    df = spark.createDataFrame([(1, [1.5, -2.0]), (2, None), (3, [])], "id int, v array<float>")
    again = df.select("id", unpack_vector(pack_vector("v")).alias("v"))
    assert {r.id: r.v for r in again.collect()} == {1: [1.5, -2.0], 2: None, 3: []}


def test_queries_beyond_the_bound_give_the_same_rows(tables, arrays, monkeypatch):
    points, asked, name = tables
    monkeypatch.setattr(scan, "QUERY_BYTES", 1_000)
    want = result(retrieval.dense_topk(points, asked, 10), name)
    assert result(retrieval.dense_topk(points, asked, 10, max_queries=3), name) == want


def test_small_batches_give_the_same_rows(spark, tables, monkeypatch):
    points, asked, name = tables
    want = result(retrieval.matryoshka_cascade(points, asked, (8, 16, 24), (40, 20, 10)), name)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:
        got = result(retrieval.matryoshka_cascade(points.coalesce(2), asked, (8, 16, 24), (40, 20, 10)), name)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == want


@pytest.mark.parametrize("bounds", [None, {8: (-0.8, 0.9), 16: (-0.7, 0.7)}])
def test_cascade_reranks_what_the_stage_before_kept(tables, arrays, bounds):
    points, asked, name = tables
    kept = None
    for dims, limit in ((8, 60), (16, 30), (24, 12)):
        p = unit(arrays[0][:, :dims])
        if bounds and dims in bounds:
            lo, hi = bounds[dims]
            p = p.astype(np.float32).astype(float)
            p = unit(lo + np.floor((np.clip(p, lo, hi) - lo) / (hi - lo) * 127 + 0.5) / 127 * (hi - lo))
        lists = best(p @ unit(arrays[2][:, :dims]).T, limit, kept)
        kept = [[i for i, _ in rows] for rows in lists]
    got = retrieval.matryoshka_cascade(points, asked, (8, 16, 24), (60, 30, 12), bounds)
    assert result(got, name) == expected(lists, name)


def test_stored_codes_rank_as_codes_made_on_the_way(spark, tables):
    points, asked, name = tables
    bounds = {8: (-0.8, 0.9), 16: (-0.7, 0.7)}
    codes = points.select("id", retrieval.code_column("text_dense", bounds).alias("codes"))
    assert codes.selectExpr("min(octet_length(codes))", "max(octet_length(codes))").first() == (24, 24)
    got = retrieval.coded_cascade(codes, points, asked, (8, 16, 24), (60, 30, 12), bounds)
    want = retrieval.matryoshka_cascade(points, asked, (8, 16, 24), (60, 30, 12), bounds)
    assert got.columns == want.columns and result(got, name) == result(want, name)
    only = retrieval.coded_cascade(codes, points, asked, (8, 16), (60, 30), bounds)
    assert result(only, name) == result(retrieval.matryoshka_cascade(points, asked, (8, 16), (60, 30), bounds), name)
    with pytest.raises(ValueError):
        retrieval.coded_cascade(codes, points, asked, (8, 16, 24), (60, 30, 12), {16: (-1, 1)})


def test_codes_of_odd_vectors(spark):
    rows = [(1, [3.0, 4.0]), (2, None), (3, [float("nan"), 1.0]), (4, [0.0, 0.0]), (5, [-9.0, 0.0]), (6, [float("inf"), 0.0])]
    points = spark.createDataFrame(rows, "id long, v array<float>")
    got = {r.id: r.c and list(r.c) for r in points.select("id", retrieval.code_column("v", {1: (5.0, 5.0), 2: (-1.0, 1.0)}).alias("c")).collect()}
    assert got == {1: [0, 102, 114], 2: None, 3: None, 4: [0, 64, 64], 5: [0, 0, 64], 6: None}
    assert points.where("false").select(retrieval.code_column("v", {1: (0.0, 1.0)})).count() == 0


def test_first_stage_reads_codes_only(spark, tables, tmp_path, capsys):
    points, asked, _ = tables
    bounds = {8: (-1.0, 1.0)}
    points.select("id", "text_dense", retrieval.code_column("text_dense", bounds).alias("codes")).write.parquet(str(tmp_path / "c"))
    stored = spark.read.parquet(str(tmp_path / "c"))
    retrieval.coded_cascade(stored, stored, asked, (8,), (5,), bounds).explain("formatted")
    scans = [x for x in capsys.readouterr().out.splitlines() if "ReadSchema" in x]
    assert any("codes" in x for x in scans) and not any("text_dense" in x for x in scans)


def test_wide_cascade_is_plain_topk_on_the_last_prefix(tables):
    points, asked, name = tables
    wide = retrieval.matryoshka_cascade(points, asked, (8, 16), (N, N))
    assert result(wide, name) == result(retrieval.dense_topk(points, asked, N, 16), name)


@pytest.mark.parametrize("zero", [True, False])
def test_sparse_topk_with_and_without_zero_scores(tables, arrays, zero):
    points, asked, name = tables
    scores = arrays[1] @ arrays[3].T
    within = None if zero else [[i for i in range(N) if scores[i, q]] for q in range(Q)]
    want = expected(best(scores, 15, within), name)
    assert result(retrieval.sparse_topk(points, asked, 15, include_zero=zero), name) == want


def test_stored_candidates(tables):
    points, asked, name = tables
    first = retrieval.dense_topk(points, asked, 60, 8)
    second = retrieval.rerank_candidates(points, asked, first, 30, 16)
    assert result(second, name) == result(retrieval.matryoshka_cascade(points, asked, (8, 16), (60, 30)), name)


def test_fusion_ignores_branch_order(tables):
    points, asked, name = tables
    parts = [
        retrieval.matryoshka_cascade(points, asked, (8, 16), (60, 30)),
        retrieval.dense_topk(points, asked, 10),
        retrieval.sparse_topk(points, asked, 10),
    ]
    one = result(retrieval.rrf_fusion(parts), name)
    assert one == result(retrieval.rrf_fusion(parts[::-1]), name)


def test_fusion_by_hand(spark):
    rows = [(0, "a", 1.0, 1), (0, "b", 0.5, 2), (0, "b", 9.0, 1), (0, "c", 8.0, 2)]
    df = spark.createDataFrame(rows, "qid int, id string, score double, rank int")
    got = [(r.id, r.score) for r in retrieval.rrf_fusion(df, limit=2).orderBy("rank").collect()]
    assert got == [("b", round(1 / 2 + 1 / 3, 9)), ("a", 0.5)]


def test_hybrid_scans_the_points_once(tables):
    points, asked, name = tables
    preset = retrieval.Preset(prefixes=(8, 16, 24), limits=(60, 30, 12), oversample=2)
    fused = retrieval.hybrid_search(points, asked, 5, preset, with_payload=False)
    parts = [
        retrieval.matryoshka_cascade(points, asked, (8, 16, 24), (60, 30, 12)),
        retrieval.dense_topk(points, asked, 10),
        retrieval.sparse_topk(points, asked, 10),
    ]
    assert result(fused, name) == result(retrieval.rrf_fusion(parts, limit=5), name)
    plan = fused._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_payload_comes_with_hits(tables):
    points, asked, name = tables
    stored = points.withColumn("payload", F.struct(F.col("id").alias("own")))
    preset = retrieval.Preset(prefixes=(8,), limits=(30,))
    hits = retrieval.hybrid_search(stored, asked, 3, preset)
    assert hits.count() == 3 * Q and hits.where("id <> payload.own").count() == 0
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_no_queries_and_missing_vectors(spark, tables):
    points, asked, name = tables
    assert retrieval.dense_topk(points, asked.where("qid < 0"), 5).count() == 0
    holes = points.withColumn("text_dense", F.when(F.pmod(F.hash("id"), F.lit(2)) == 0, F.col("text_dense")))
    whole = holes.where("text_dense is not null")
    assert result(retrieval.dense_topk(holes, asked, 9), name) == result(retrieval.dense_topk(whole, asked, 9), name)


def test_bad_parameters(tables):
    points, asked, _ = tables
    with pytest.raises(ValueError):
        retrieval.hybrid_search(points, asked, 0)
    with pytest.raises(ValueError):
        retrieval.get_preset("other")


def test_presets():
    pipeline, demo = retrieval.PRESETS["pipeline"], retrieval.PRESETS["demo"]
    assert pipeline.stage_limits(5) == (200, 100, 50) and pipeline.oversample == 2
    assert demo.stage_limits(10) == (100, 50, 10) and demo.oversample == 1
    assert (pipeline.vocabulary, demo.vocabulary) == (256, 635)


def test_vector_expressions(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0], [0.0, 0.0])], "a array<float>, b array<float>, z array<float>")
    row = df.select(
        cosine_similarity("a", "b").alias("c"), cosine_similarity("a", "z").alias("cz"),
        unit_vector("a").alias("u"), unit_vector("z").alias("uz"),
        int8_encode("a", F.lit(0.0), F.lit(4.0)).alias("e"),
        int8_decode(int8_encode("a", F.lit(0.0), F.lit(4.0)), F.lit(0.0), F.lit(4.0)).alias("d"),
        int8_encode("a", F.lit(5.0), F.lit(5.0)).alias("flat"),
    ).first()
    assert row.c == pytest.approx(0.96) and row.cz == 0
    assert row.u == pytest.approx([0.6, 0.8]) and row.uz == [0, 0]
    assert row.e == [95, 127] and row.d == pytest.approx([95 / 127 * 4, 4]) and row.flat == [0, 0]


def test_bounds_cover_all_unit_prefixes(tables, arrays):
    points, _, _ = tables
    got = retrieval.bounds_dict(retrieval.int8_bounds(points, (8, 16)))
    for n in (8, 16):
        u = unit(arrays[0][:, :n])
        assert got[n] == pytest.approx((u.min(), u.max()))


def vectors_of(spark, rows, key="id"):
    return spark.createDataFrame(rows, f"{key} long, text_dense array<double>, text_sparse array<double>")


def ranked(df):
    return [(r.qid, r.id) for r in df.orderBy("qid", "rank").collect()]


def test_points_without_a_finite_score_take_no_place(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(n, [1.0, 0.1 * n], [1.0]) for n in range(6)]
    rows += [(10, [nan, 1.0], [nan]), (11, [inf, 1.0], [1.0]), (12, [None, 1.0], [1.0])]
    asked = vectors_of(spark, [(0, [1.0, 0.0], [1.0])], "qid")
    for points in (vectors_of(spark, rows), vectors_of(spark, rows).coalesce(1)):
        assert ranked(retrieval.dense_topk(points, asked, 3)) == [(0, 0), (0, 1), (0, 2)]
        assert ranked(retrieval.matryoshka_cascade(points, asked, (1, 2), (9, 3))) == [(0, 0), (0, 1), (0, 2)]


def test_a_point_without_one_vector_stays_in_the_other_branch(spark):
    points = vectors_of(spark, [(1, [1.0, 0.0], None), (2, None, [1.0]), (3, [0.0, 1.0], [0.5])])
    asked = vectors_of(spark, [(0, [1.0, 0.0], [1.0])], "qid")
    branches = [retrieval.dense_branch(5), retrieval.sparse_branch(5)]
    got = {(r.branch, r.id) for r in scan.branch_scan(points, asked, branches).collect()}
    assert got == {("dense", 1), ("dense", 3), ("sparse", 2), ("sparse", 3)}


def test_queries_without_a_vector_get_no_rows_and_ragged_ones_raise(spark):
    points = vectors_of(spark, [(1, [1.0, 0.0], [1.0]), (2, [0.0, 1.0], [1.0])])
    asked = vectors_of(spark, [(0, [1.0, 0.0], [1.0]), (1, None, [1.0]), (2, [0.0, 1.0], None)], "qid")
    assert ranked(retrieval.dense_topk(points, asked, 1)) == [(0, 1), (2, 2)]
    assert {q for q, _ in ranked(retrieval.sparse_topk(points, asked, 1))} == {0, 1}
    ragged = vectors_of(spark, [(0, [1.0], [1.0]), (1, [1.0, 0.0, 0.0], [1.0])], "qid")
    with pytest.raises(ValueError):
        retrieval.dense_topk(points, ragged, 1)
    bent = points.union(vectors_of(spark, [(3, [1.0], [1.0])]))
    with pytest.raises(Exception, match="equal lengths"):
        retrieval.dense_topk(bent, asked, 1).collect()


def test_null_ids_raise(spark):
    points = vectors_of(spark, [(None, [1.0, 0.0], [1.0]), (2, [0.0, 1.0], [1.0])])
    with pytest.raises(Exception, match="no id"):
        retrieval.dense_topk(points, vectors_of(spark, [(0, [1.0, 0.0], [1.0])], "qid"), 1).collect()


def test_tasks_and_so_shuffled_rows_of_a_scan_are_bounded(spark, tables):
    points, asked, name = tables
    split = points.repartition(200)
    slots = scan.TASKS_PER_SLOT * spark.sparkContext.defaultParallelism
    seen = split.select("id", "text_dense").coalesce(slots).rdd.getNumPartitions()
    assert seen <= slots
    assert result(retrieval.dense_topk(split, asked, 4), name) == result(retrieval.dense_topk(points, asked, 4), name)


def test_points_are_read_once_for_many_blocks_of_queries(spark, monkeypatch):
    from loomdex.operators import scan

    rng = np.random.default_rng(8)
    points = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(300, 8)))], "id long, text_dense array<double>")
    asked = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(200, 8)))], "qid long, text_dense array<double>")
    want = retrieval.dense_topk(points, asked, 5)
    seen = []
    real = scan._scan
    monkeypatch.setattr(scan, "_scan", lambda *a: (seen.append(len(a[1])), real(*a))[1])
    got = retrieval.dense_topk(points, asked, 5, max_queries=30)
    assert seen == [7] and got.exceptAll(want).count() == 0 and got.count() == want.count() == 1000
    assert retrieval.dense_topk(points, asked, 5, max_queries=10).exceptAll(want).count() == 0
    assert seen == [7, 8, 8, 4]
