"""Branch rankings, rank fusion and hybrid search over a table of points."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomdex.functions.vectors import (
    cosine_similarity,
    int8_decode,
    int8_encode,
    unit_vector,
    vector_prefix,
)
from loomdex.operators.relational import top_per_group
from loomdex.operators.scan import Branch, Stage, branch_scan, encoded, single_unit
from loomdex.session import written

DENSE = "text_dense"
SPARSE = "text_sparse"
SCORE_DIGITS = 9
Bounds = Mapping[int, tuple[float, float]]


@dataclass(frozen=True)
class Preset:
    """Parameters of one search variant."""

    prefixes: tuple[int, ...] = (64, 128, 256)
    limits: tuple[int | None, ...] = (200, 100, 50)  # None: the result limit
    quantised: tuple[int, ...] = ()
    oversample: int = 1
    vocabulary: int = 256
    padded: bool = True
    query_weights: str = "binary"
    default_limit: int = 5

    def stage_limits(self, limit: int) -> tuple[int, ...]:
        return tuple(limit if n is None else n for n in self.limits)


# The two search variants differ in these parameters.
PRESETS = {
    "pipeline": Preset(
        limits=(200, 100, 50), quantised=(64, 128), oversample=2, vocabulary=256, padded=True,
        query_weights="binary", default_limit=5,
    ),
    "demo": Preset(
        limits=(100, 50, None), quantised=(), oversample=1, vocabulary=635, padded=False,
        query_weights="idf", default_limit=10,
    ),
}
RRF_K = 2


def get_preset(preset: str | Preset) -> Preset:
    if isinstance(preset, Preset):
        return preset
    if preset not in PRESETS:
        raise ValueError(f"unknown preset {preset!r}; choose from {sorted(PRESETS)}")
    return PRESETS[preset]


def dense_branch(k: int, column: str = DENSE, prefix: int | None = None, name: str = "dense") -> Branch:
    return Branch(name, column, (Stage(k, prefix),))


def cascade_branch(
    prefixes: Sequence[int],
    limits: Sequence[int],
    bounds: Bounds | None = None,
    column: str = DENSE,
    name: str = "cascade",
) -> Branch:
    bounds = bounds or {}
    stages = tuple(Stage(n, d, bounds.get(d)) for d, n in zip(prefixes, limits, strict=True))
    return Branch(name, column, stages)


def sparse_branch(
    k: int, column: str = SPARSE, include_zero: bool = True, name: str = "sparse"
) -> Branch:
    return Branch(name, column, (Stage(k),), "dot", include_zero)


def dense_topk(
    points: DataFrame,
    queries: DataFrame,
    k: int,
    prefix: int | None = None,
    vector: str = DENSE,
    **options,
) -> DataFrame:
    """Best ``k`` points per query by cosine, on whole vectors or on their first elements."""
    return branch_scan(points, queries, [dense_branch(k, vector, prefix)], **options).drop("branch")


def matryoshka_cascade(
    points: DataFrame,
    queries: DataFrame,
    prefixes: Sequence[int] = (64, 128, 256),
    limits: Sequence[int] = (200, 100, 50),
    bounds: Bounds | None = None,
    vector: str = DENSE,
    **options,
) -> DataFrame:
    """Coarse-to-fine ranking: each prefix length re-ranks what the shorter one kept."""
    branch = cascade_branch(prefixes, limits, bounds, vector)
    return branch_scan(points, queries, [branch], **options).drop("branch")


def code_column(vector: Column | str, bounds: Bounds) -> Column:
    """Stored 8-bit codes: a byte for each element of each prefix in ``bounds``, from short to long.

    A null vector has no codes, nor has one with elements that are not finite. Vectors must be as long as the longest prefix.
    """
    spans = sorted((n, tuple(b)) for n, b in bounds.items())

    @F.arrow_udf(T.BinaryType())
    def encode(batch: pa.Array) -> pa.Array:
        valid = batch.is_valid().to_numpy(zero_copy_only=False)
        out: list[bytes | None] = [None] * len(batch)
        rows = batch.drop_null()
        if len(rows):
            matrix = rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), -1)
            finite = np.isfinite(matrix[:, : spans[-1][0]]).all(axis=1)
            parts = [encoded(single_unit(matrix[finite, :n]), b) for n, b in spans]
            codes = np.concatenate(parts, axis=1).astype(np.uint8)
            for at, row in zip(np.flatnonzero(valid)[finite].tolist(), codes):
                out[at] = row.tobytes()
        return pa.array(out, pa.binary())

    return encode(vector)


def coded_cascade(
    codes: DataFrame,
    points: DataFrame,
    queries: DataFrame,
    prefixes: Sequence[int],
    limits: Sequence[int],
    bounds: Bounds,
    vector: str = DENSE,
    **options,
) -> DataFrame:
    """The coarse-to-fine ranking of :func:`matryoshka_cascade` from stored ``codes`` (id, codes).

    The stages over prefixes in ``bounds`` come first and read the codes only, a byte for an element. The later ones
    read the vectors of what is left.
    """
    coded = sorted(bounds)
    if list(prefixes[: len(coded)]) != coded:
        raise ValueError("the stages over stored codes must be the first ones")
    places = dict(zip(coded, np.cumsum([0, *coded]).tolist()))
    stages = tuple(Stage(n, d, tuple(bounds[d]), places[d]) for d, n in zip(coded, limits))
    branch = Branch("cascade", "codes", stages, codes=sum(coded))
    found = branch_scan(codes, queries.select("qid", F.col(vector).alias("codes")), [branch], **options).drop("branch")
    for d, n in list(zip(prefixes, limits, strict=True))[len(coded) :]:
        found = rerank_candidates(points, queries, written(found, "candidates"), n, d, vector)
    return found


def sparse_topk(
    points: DataFrame,
    queries: DataFrame,
    k: int,
    include_zero: bool = True,
    vector: str = SPARSE,
    **options,
) -> DataFrame:
    """Best ``k`` points per query by dot product; rows that score 0 fill up unless excluded."""
    return branch_scan(points, queries, [sparse_branch(k, vector, include_zero)], **options).drop("branch")


def candidate_semi_join(points: DataFrame, candidates: DataFrame) -> DataFrame:
    """Points that an earlier stage kept for any query, for stages that are stored apart."""
    return points.join(candidates.select("id").distinct(), "id", "left_semi")


def rerank_candidates(
    points: DataFrame,
    queries: DataFrame,
    candidates: DataFrame,
    k: int,
    prefix: int | None = None,
    vector: str = DENSE,
) -> DataFrame:
    """Score only the (qid, id) pairs of an earlier stage and keep the best ``k`` per query."""

    def part(column):
        return vector_prefix(column, prefix) if prefix else column

    kept = candidate_semi_join(points.select("id", vector), candidates)
    pairs = (
        candidates.select("qid", "id")
        .join(kept.withColumnRenamed(vector, "_p"), "id")
        .join(queries.select("qid", F.col(vector).alias("_q")), "qid")
    )
    scored = pairs.select(
        "qid",
        "id",
        F.round(cosine_similarity(part(F.col("_p")), part(F.col("_q"))), SCORE_DIGITS).alias("score"),
    )
    return top_per_group(scored, ["qid"], [F.desc("score"), "id"], k)


def branch_union(branches: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, branches)


def rrf_fusion(
    branches: Sequence[DataFrame] | DataFrame, k: int = RRF_K, limit: int = 5
) -> DataFrame:
    """Sum of 1 / (k + position) over the branches, position 0 being the best; top ``limit``."""
    rows = branches if isinstance(branches, DataFrame) else branch_union(branches)
    fused = rows.groupBy("qid", "id").agg(
        F.round(F.sum(F.lit(1.0) / (F.lit(k) + F.col("rank") - 1)), SCORE_DIGITS).alias("score")
    )
    return top_per_group(fused, ["qid"], [F.desc("score"), "id"], limit)


def payload_attach(
    hits: DataFrame, points: DataFrame, payload: str = "payload", bucket_chars: int = 0
) -> DataFrame:
    """Attach payloads to final hits.

    Hits that were written first have a known size, by which Spark decides whether to broadcast
    them. The storage partition follows from the id, so only the hits' partitions are read then.
    """
    if bucket_chars and "id_bucket" in points.columns:
        bucketed = hits.withColumn("id_bucket", F.substring("id", 1, bucket_chars))
        return points.select("id_bucket", "id", payload).join(bucketed, ["id_bucket", "id"]).drop("id_bucket")
    return points.select("id", payload).join(hits, "id")


def unit_prefix(vector, n: int):
    return unit_vector(vector_prefix(vector, n))


def int8_bounds(points: DataFrame, prefixes: Sequence[int], vector: str = DENSE) -> DataFrame:
    """One row (prefix, low, high) per prefix length: the value range over the whole table."""

    def span(n: int):
        return F.transform(
            F.array(unit_prefix(vector, n)),
            lambda u: F.struct(
                F.lit(n).alias("prefix"),
                F.array_min(u).cast("double").alias("low"),
                F.array_max(u).cast("double").alias("high"),
            ),
        )[0]

    measured = points.select(F.inline(F.array(*[span(n) for n in prefixes])))
    return measured.groupBy("prefix").agg(F.min("low").alias("low"), F.max("high").alias("high"))


def bounds_dict(bounds: DataFrame) -> dict[int, tuple[float, float]]:
    """The few rows of :func:`int8_bounds` as a dictionary (one row per prefix length)."""
    merged = bounds.groupBy("prefix").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    return {r["prefix"]: (r["low"], r["high"]) for r in merged.collect() if r["low"] is not None}


def int8_quantize(df: DataFrame, vector: str, out: str = "codes") -> DataFrame:
    """Scalar 8-bit codes of a vector column over its global value range.

    Adds the codes and the decoded vector; the range is one scalar subquery over the column.
    """
    span = df.agg(
        F.struct(
            F.min(F.array_min(vector)).cast("double").alias("low"),
            F.max(F.array_max(vector)).cast("double").alias("high"),
        ).alias("r")
    ).scalar()
    coded = df.withColumn("_span", span)
    coded = coded.withColumn(out, int8_encode(vector, F.col("_span.low"), F.col("_span.high")))
    return coded.withColumn(
        out + "_decoded", int8_decode(out, F.col("_span.low"), F.col("_span.high"))
    ).drop("_span")


def hybrid_branches(
    limit: int, preset: str | Preset = "pipeline", bounds: Bounds | None = None
) -> list[Branch]:
    p = get_preset(preset)
    used = {d: b for d, b in (bounds or {}).items() if d in p.quantised}
    return [
        cascade_branch(p.prefixes, p.stage_limits(limit), used),
        dense_branch(limit * p.oversample),
        sparse_branch(limit * p.oversample),
    ]


def hybrid_search(
    points: DataFrame,
    queries: DataFrame,
    limit: int | None = None,
    preset: str | Preset = "pipeline",
    bounds: Bounds | None = None,
    k: int = RRF_K,
    with_payload: bool = True,
    **options,
) -> DataFrame:
    """Fuse cascade, dense and sparse rankings of every query; one scan serves all three.

    Returns (qid, id, score, rank) and, with ``with_payload``, the payload of each hit.
    Quantised stages of the preset measure their value range unless ``bounds`` gives it, which is one more
    scan. ``points`` are read up to three times in all, so write them first where they are costly to make.
    """
    p = get_preset(preset)
    limit = p.default_limit if limit is None else limit
    if limit < 1:
        raise ValueError("limit must be positive")
    if p.quantised and bounds is None:
        bounds = bounds_dict(int8_bounds(points, p.quantised))
    found = branch_scan(points, queries, hybrid_branches(limit, p, bounds), SCORE_DIGITS, **options)
    fused = rrf_fusion(found, k, limit)
    if not with_payload:
        return fused
    return payload_attach(written(fused, "hits"), points).select("qid", "rank", "id", "score", "payload")
