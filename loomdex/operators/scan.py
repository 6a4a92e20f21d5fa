"""Exact nearest-vector scan for many queries at once.

The points are read once. Each task holds the query matrix, scores whole Arrow batches with matrix
products and keeps only the best rows per query, so what is shuffled is (queries x limit) rows per
task and not one row per pair. The scan runs in few long tasks. Queries are written once and handed to the
tasks in blocks of bounded size, several of them to one scan; the points are never moved. The driver holds one
block at a time.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomdex.functions.vectors import INT8_LEVELS
from loomdex.session import written

QUERY_ROWS = 8192  # queries of one block, which is collected and broadcast to every task
QUERY_BYTES = 128 << 20  # and the bytes that they may take
SCAN_BLOCKS = 8  # blocks that the tasks of one scan hold
TASKS_PER_SLOT = 4  # tasks of a scan for each slot of the cluster
SCORE_CELLS = 4_000_000  # scores held at a time
SCAN_ROWS = 2048  # points of a batch that are widened to double precision and scored at a time
MERGE_SALTS = 32


@dataclass(frozen=True)
class Stage:
    """One ranking step: the first ``dims`` elements (all if None), how many rows survive it, and
    the value range of 8-bit codes if the step compares quantised vectors. ``at`` is the place of the stage's
    codes in a column of stored codes; without it codes are made from the vectors of each batch."""

    limit: int
    dims: int | None = None
    bounds: tuple[float, float] | None = None
    at: int | None = None


@dataclass(frozen=True)
class Branch:
    """A chain of stages over one vector column. ``keep_zero`` admits rows that score 0. Where the points
    have stored codes in that column, ``codes`` is how many bytes they are."""

    name: str
    column: str
    stages: tuple[Stage, ...]
    metric: str = "cosine"
    keep_zero: bool = True
    codes: int | None = None


def encoded(unit: np.ndarray, bounds: tuple[float, float]) -> np.ndarray:
    """Codes from 0 to ``INT8_LEVELS`` over a value range."""
    low, high = bounds
    if not high > low:
        return np.zeros_like(unit)
    return np.floor((np.clip(unit, low, high) - low) / (high - low) * INT8_LEVELS + 0.5)


def _decoded(codes: np.ndarray, bounds: tuple[float, float]) -> np.ndarray:
    low, high = bounds
    return low + codes / INT8_LEVELS * max(high - low, 0.0)


def single_unit(part: np.ndarray) -> np.ndarray:
    """Unit vectors in single precision, of which codes are taken."""
    return unit_rows(part).astype(np.float32).astype(np.float64)


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    norms = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))[:, None]
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def _stage_matrix(matrix: np.ndarray, stage: Stage, metric: str, is_point: bool) -> np.ndarray:
    """Vectors of one stage, scaled so that a plain product gives the stage's score."""
    if is_point and stage.at is not None:
        return unit_rows(_decoded(matrix[:, stage.at : stage.at + stage.dims], stage.bounds))
    part = (matrix if stage.dims is None else matrix[:, : stage.dims]).astype(np.float64)
    if metric == "dot":
        return part
    if is_point and stage.bounds is not None:
        part = _decoded(encoded(single_unit(part), stage.bounds), stage.bounds)
    return unit_rows(part)


def _scored_by(matrix: np.ndarray, stage: Stage, metric: str) -> tuple[np.ndarray, np.ndarray | None]:
    """What a batch is multiplied by, and the norms to divide the products by; made once for a batch.
    Whole rows are not scaled: it is cheaper to divide the products."""
    if metric == "dot" or stage.bounds is not None:
        return _stage_matrix(matrix, stage, metric, True), None
    part = (matrix if stage.dims is None else matrix[:, : stage.dims]).astype(np.float64)
    return part, np.sqrt(np.einsum("ij,ij->i", part, part))[:, None]


def _stage_scores(part: np.ndarray, norms: np.ndarray | None, queries: np.ndarray, digits: int) -> np.ndarray:
    """Scores of all rows against a block of scaled queries. What has no finite score takes no part."""
    score = part @ queries.T
    if norms is not None:
        np.divide(score, norms, out=score, where=norms > 0)
    score = np.round(score, digits, out=score) + 0.0  # -0.0 and 0.0 are the same score
    score[~np.isfinite(score)] = -np.inf
    return score


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int | None = None, codes: int | None = None) -> np.ndarray:
    """Rows of a vector column: arrays, packed bytes of ``dim`` numbers, or that many stored ``codes``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if column.null_count:
        raise ValueError("a vector is null")
    if pa.types.is_list(column.type) or pa.types.is_large_list(column.type):
        sizes = np.diff(column.offsets.to_numpy())
        if n and (sizes != (sizes[0] if dim is None else dim)).any():
            raise ValueError("vectors of one column must have equal lengths")
        flat = column.flatten().to_numpy(zero_copy_only=False)
    else:
        data = _bytes_of(column)
        if codes is not None:
            if len(data) != n * codes:
                raise ValueError(f"stored codes are not {codes} bytes each")
            return np.frombuffer(data, np.uint8).reshape(n, codes)
        width = len(data) // max(n * dim, 1)
        if width not in (4, 8) or n * dim * width != len(data):
            raise ValueError(f"packed vectors do not hold {dim} numbers each")
        flat = np.frombuffer(data, dtype="<f4" if width == 4 else "<f8")
    return flat.reshape(n, len(flat) // max(n, 1))


def _bytes_of(column: pa.Array) -> memoryview:
    """The values of a binary array without nulls, one after the other and without a copy."""
    large = pa.types.is_large_binary(column.type)
    _, offsets, values = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64 if large else np.int32)
    start, stop = ends[column.offset], ends[column.offset + len(column)]
    return memoryview(values)[start:stop] if values is not None else memoryview(b"")


class _Best:
    """Running top rows per query for one branch."""

    def __init__(self, branch: Branch, queries: np.ndarray, digits: int):
        self.branch = branch
        self.digits = digits
        self.limit = branch.stages[0].limit
        self.width = queries.shape[1]
        self.parts = [_stage_matrix(queries, s, branch.metric, False) for s in branch.stages]
        self.floor = np.full(len(queries), -np.inf)
        self.q = np.empty(0, dtype=np.int64)
        self.ids: np.ndarray | None = None
        self.scores = np.empty((0, len(branch.stages)))

    def add(self, ids: np.ndarray, order: np.ndarray, matrix: np.ndarray) -> None:
        """``order`` sorts the rows of ``matrix`` by id, so that the first rows among equal scores
        are the ones to keep; ``ids`` are in that order."""
        n, step = len(ids), max(1, SCORE_CELLS // max(len(ids), 1))
        rows, queries, firsts = [], [], []
        part, norms = _scored_by(matrix, self.branch.stages[0], self.branch.metric)
        for start in range(0, len(self.floor), step):
            block = self.parts[0][start : start + step]
            score = _stage_scores(part, norms, block, self.digits)
            if not self.branch.keep_zero:
                score[score == 0] = -np.inf
            threshold = self.floor[start : start + step].copy()
            if n > self.limit:
                kth = np.partition(score, n - self.limit, axis=0)[n - self.limit]
                threshold = np.maximum(threshold, kth)
            score = score[order]
            keep = score >= threshold
            keep &= score > -np.inf
            crowded = np.nonzero(keep.sum(axis=0) > self.limit)[0]
            if len(crowded):
                many, limit = score[:, crowded], threshold[crowded]
                room = self.limit - (many > limit).sum(axis=0)
                tie = many == limit
                keep[:, crowded] &= ~(tie & (np.cumsum(tie, axis=0) > room))
            r, q = np.nonzero(keep)
            rows.append(r)
            queries.append(q + start)
            firsts.append(score[r, q])
        rows, queries, firsts = map(np.concatenate, (rows, queries, firsts))
        if len(rows):
            self._merge(ids, order, matrix, rows, queries, firsts)

    def _merge(self, ids, order, matrix, rows, queries, first) -> None:
        stages = self.branch.stages
        scores = np.empty((len(rows), len(stages)))
        scores[:, 0] = first
        if len(stages) > 1:
            # the later stages look at the rows that got through the first one only
            used, where = np.unique(rows, return_inverse=True)
            kept = matrix[order[used]]
        for i in range(1, len(stages)):
            points = _stage_matrix(kept, stages[i], self.branch.metric, True)
            for s in range(0, len(rows), 50_000):
                part = slice(s, s + 50_000)
                pair = np.einsum("ij,ij->i", points[where[part]], self.parts[i][queries[part]])
                scores[part, i] = np.round(pair, self.digits) + 0.0
        scores[~np.isfinite(scores)] = -np.inf
        q, names = queries, ids[rows]
        rest = np.zeros(0, bool)
        if self.ids is not None:
            # only the queries that gained a row are ranked again
            gained = np.zeros(len(self.floor), bool)
            gained[queries] = True
            rest = ~gained[self.q]
            q = np.concatenate([self.q[~rest], q])
            names = np.concatenate([self.ids[~rest], names])
            scores = np.concatenate([self.scores[~rest], scores])
        by_rank = np.lexsort((names, -scores[:, 0], q))
        q, names, scores = q[by_rank], names[by_rank], scores[by_rank]
        starts = np.searchsorted(q, q, side="left")
        rank = np.arange(len(q)) - starts
        keep = rank < self.limit
        full = rank == self.limit - 1
        self.floor[q[full]] = scores[full, 0]
        q, names, scores = q[keep], names[keep], scores[keep]
        if rest.any():
            q = np.concatenate([self.q[rest], q])
            names = np.concatenate([self.ids[rest], names])
            scores = np.concatenate([self.scores[rest], scores])
        self.q, self.ids, self.scores = q, names, scores


def _sorted_ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        raise ValueError("a point has no id")
    ids = column.to_numpy(zero_copy_only=False)
    if ids.dtype == object:
        ids = ids.astype(str)
    order = np.argsort(ids, kind="stable")
    return ids[order], order


def _result(best: Sequence[_Best], qids: pa.Array, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    depth = sum(1 for n in schema.names if n.startswith("s"))
    for b in best:
        if b.ids is None or not len(b.q):
            continue
        padded = [b.scores[:, min(i, b.scores.shape[1] - 1)] for i in range(depth)]
        columns = [
            pa.array([b.branch.name] * len(b.q), type=pa.string()),
            qids.take(pa.array(b.q)).cast(schema.field("qid").type),
            pa.array(b.ids).cast(schema.field("id").type),
            *[pa.array(s) for s in padded],
        ]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def _score_batches(
    batches: Iterator[pa.RecordBatch],
    branches: Sequence[Branch],
    blocks: Sequence[dict[str, tuple[pa.Array, np.ndarray]]],
    schema: pa.Schema,
    digits: int,
) -> Iterator[pa.RecordBatch]:
    """``blocks`` have the ids and vectors of queries by column; a row without a vector is left out of the
    branches over that column only."""
    best = [(_Best(b, asked[b.column][1], digits), asked[b.column][0]) for asked in blocks for b in branches if len(asked[b.column][0])]
    parts = (batch.slice(start, SCAN_ROWS) for batch in batches for start in range(0, batch.num_rows, SCAN_ROWS))
    for batch in parts:
        cache: dict[str, tuple] = {}
        for b, _ in best:
            column = b.branch.column
            if column not in cache:
                own = batch.select(["id", column])
                own = own.filter(own.column(column).is_valid()) if own.column(column).null_count else own
                cache[column] = (*_sorted_ids(own.column("id")), _matrix(own.column(column), b.width, b.branch.codes))
            if len(cache[column][0]):
                b.add(*cache[column])
    for b, qids in best:
        yield from _result([b], qids, schema)


def _spark_schema(points: DataFrame, queries: DataFrame, depth: int) -> T.StructType:
    fields = [
        T.StructField("branch", T.StringType()),
        T.StructField("qid", queries.schema["qid"].dataType),
        T.StructField("id", points.schema["id"].dataType),
        *[T.StructField(f"s{i + 1}", T.DoubleType()) for i in range(depth)],
    ]
    return T.StructType(fields)


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def branch_columns(branches: Sequence[Branch]) -> list[str]:
    return sorted({b.column for b in branches})


def branch_scan(
    points: DataFrame,
    queries: DataFrame,
    branches: Sequence[Branch],
    digits: int = 9,
    max_queries: int = QUERY_ROWS,
) -> DataFrame:
    """Ranked rows (branch, qid, id, score, rank) of every branch from one scan of the points for up to
    ``SCAN_BLOCKS`` blocks of queries.

    ``points`` has ``id`` and the vector columns, as arrays or packed; ``queries`` has ``qid`` and
    array columns of the same names. A point or query without a vector takes no part in the branches over it, nor do
    vectors whose score is not finite; vectors of unequal length and points without an id raise an error. Scores are
    rounded to ``digits`` places before ranking and equal scores are ordered by id, so results do not depend on
    partitioning.
    """
    columns = branch_columns(branches)
    depth = max(len(b.stages) for b in branches)
    schema = _spark_schema(points, queries, depth)
    sc = points.sparkSession.sparkContext
    # few, long tasks: each gives queries x limit rows, however much it has read
    present = points.select("id", *columns).coalesce(TASKS_PER_SLOT * sc.defaultParallelism)
    asked = queries.select("qid", *columns)
    size = asked.agg(F.count(F.lit(1)).alias("n"), *[F.max(F.size(c)).alias(c) for c in columns]).first()
    per_block = max(1, min(max_queries, QUERY_BYTES // (8 * max(1, sum(size[c] or 0 for c in columns)))))
    n_blocks = -(-size["n"] // per_block)
    if n_blocks > 1:  # written once, so that what makes the queries does not run for each block
        asked = written(asked.withColumn("_block", F.pmod(F.xxhash64("qid"), F.lit(n_blocks))), "queries", "_block")
    found = [
        _scan(present, [asked.where(F.col("_block") == k).drop("_block") if n_blocks > 1 else asked for k in some], branches, columns, schema, digits)
        for some in (range(at, min(at + SCAN_BLOCKS, n_blocks)) for at in range(0, n_blocks, SCAN_BLOCKS))
    ]
    if not found:
        found = [points.sparkSession.createDataFrame([], schema)]
    return _finish(reduce(DataFrame.union, found), branches, depth)


def _block(asked, columns) -> dict[str, tuple[pa.Array, np.ndarray]]:
    held = asked.toArrow()  # bounded in rows and bytes
    vectors = {}
    for c in columns:
        own = held.filter(held.column(c).is_valid())
        vectors[c] = own.column("qid").combine_chunks(), _matrix(own.column(c))
    return vectors


def _scan(present, some, branches, columns, schema, digits) -> DataFrame:
    shared = [present.sparkSession.sparkContext.broadcast(_block(asked, columns)) for asked in some]
    target = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _score_batches(batches, branches, [s.value for s in shared], target, digits)

    return present.mapInArrow(run, schema)


def _finish(found: DataFrame, branches: Sequence[Branch], depth: int) -> DataFrame:
    """Merge the rows of all tasks, first within salted parts of a query and then per query, and
    apply the stages one after the other."""

    def limit(i: int):
        out = F.lit(0)
        for b in branches:
            stage = b.stages[min(i, len(b.stages) - 1)]
            out = F.when(F.col("branch") == b.name, stage.limit).otherwise(out)
        return out

    widest = max(b.stages[0].limit for b in branches)
    part = Window.partitionBy("branch", "qid", "_salt").orderBy(F.desc("s1"), "id")
    out = (
        found.withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(MERGE_SALTS)))
        .withColumn("_part_rank", F.row_number().over(part))
        .where(F.col("_part_rank") <= widest)
    )
    for i in range(depth):
        window = Window.partitionBy("branch", "qid").orderBy(F.desc(f"s{i + 1}"), "id")
        out = out.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= limit(i))
    return out.select(
        "branch", "qid", "id", F.col(f"s{depth}").alias("score"), F.col("rank").cast("bigint").alias("rank")
    )
