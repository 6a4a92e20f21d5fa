"""Approximate nearest neighbours by an inverted multi-index.

Both halves of the unit vectors are quantised on their own (``CELLS`` centroids each, fitted to a bounded sample of
``SAMPLE`` rows); every row is indexed in the cell of its pair of centroids. A query walks over pairs of
centroids by growing summed distance, with a heap, until the cells it has seen hold ``SHARE`` of all rows, and k that are
not its own. Their rows are reranked by cosine in double precision on the original vectors.

The table of cell counts (CELLS x CELLS) and the centroids have a fixed size and go to every task; queries and rows
meet by a shuffle on the cell, large cells in parts of ``PART`` rows. Each part keeps its k best per query. The share holds at any number
of rows; it is what random vectors of 64 components need for a recall well over 0.9, clustered ones need far less.

Vectors that are null, zero, of another length than most, or hold null or non-finite components take no part, as queries or as
candidates; nor do rows without an id. Repeated ids are candidates each, and a query's own id is none. With fewer
candidates than k all are found (all cells are walked). Other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomdex.llm.common import keep, per_task

CELLS = 16
SAMPLE = 20_000
SHARE = 0.7
#: Rows of a part of a cell, and queries that meet it at once.
PART, QUERIES = 4_096, 16_384
ROUNDS = 12


def usable(vectors: DataFrame) -> DataFrame:
    """id and vector of the rows that can take part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.where(F.col("id").isNotNull() & F.col("vector").isNotNull() & finite & F.exists("vector", lambda x: x != 0))


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # no overflow or underflow of squares
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def distances(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (rows * rows).sum(axis=1)[:, None] - 2 * rows @ centroids.T + (centroids * centroids).sum(axis=1)


def fit(rows: np.ndarray, cells: int, seed: int = 3) -> np.ndarray:
    """Centroids by Lloyd's rounds from distinct starting rows; fewer if there are fewer distinct rows."""
    distinct = np.unique(rows, axis=0)
    start = np.random.default_rng(seed).permutation(len(distinct))[:cells]
    centroids = distinct[start]
    for _ in range(ROUNDS):
        near = distances(rows, centroids).argmin(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, rows)
        n = np.bincount(near, minlength=len(centroids))
        centroids = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centroids)
    return centroids


def halves(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    middle = rows.shape[1] // 2
    return rows[:, :middle], rows[:, middle:]


def walk(first: np.ndarray, second: np.ndarray, counts: np.ndarray, enough: int) -> list[int]:
    """Cells by summed distance of their two centroids until they hold ``enough`` rows (the multi-sequence walk)."""
    by_first, by_second = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap, out, seen = [(first[by_first[0]] + second[by_second[0]], 0, 0)], [], 0
    reached = {(0, 0)}
    while heap and seen < enough:
        _, i, j = heapq.heappop(heap)
        cell = int(by_first[i]) * len(second) + int(by_second[j])
        if counts[cell]:
            out.append(cell)
            seen += int(counts[cell])
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(first) and b < len(second) and (a, b) not in reached:
                reached.add((a, b))
                heapq.heappush(heap, (first[by_first[a]] + second[by_second[b]], a, b))
    return out


def _assign(model):
    def make():
        centroids = model.value

        def work(batch):
            rows = halves(unit(matrix(batch.column("vector"))))
            a, b = (distances(r, c).argmin(axis=1) for r, c in zip(rows, centroids))
            cell = pa.array((a * len(centroids[1]) + b).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("vector"), cell], names=["id", "vector", "cell"])

        return work

    return per_task(make)


def _probe(model, enough: int, parts):
    def make():
        centroids = model.value
        counts, part = parts.value

        def work(batch):
            rows = halves(unit(matrix(batch.column("vector"))))
            first, second = (distances(r, c) for r, c in zip(rows, centroids))
            for lo in range(0, len(first), 64):
                at, cells, pieces = [], [], []
                for i in range(lo, min(lo + 64, len(first))):
                    for cell in walk(first[i], second[i], counts, enough):
                        for p in range(-(-int(counts[cell]) // part)):
                            at.append(i)
                            cells.append(cell)
                            pieces.append(p)
                own = batch.take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [own.column("id"), own.column("vector"), pa.array(cells, pa.int32()), pa.array(pieces, pa.int32())],
                    names=["id", "vector", "cell", "part"],
                )

        return work

    return per_task(make)


def _best(k: int):
    """Of one part of a cell: the k best of its rows for each of the queries that reach it, in blocks of queries."""

    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        found = [np.zeros((0, 2), np.int64)], [np.zeros(0)]
        if rows.num_rows and queries.num_rows:
            asked, ids = queries.column("id").to_numpy(), rows.column("id").to_numpy()
            left, right = (matrix(t.column("vector").combine_chunks()) for t in (queries, rows))
            turned = unit(right).T
            for lo in range(0, len(asked), 256):
                own, vectors = asked[lo : lo + 256], left[lo : lo + 256]
                scores = unit(vectors) @ turned
                scores[own[:, None] == ids[None, :]] = -np.inf
                width = min(k, len(ids))
                cut = np.partition(scores, len(ids) - width, axis=1)[:, len(ids) - width]
                i, j = np.nonzero((scores >= cut[:, None] - 1e-9) & (scores > -np.inf))
                exact = cosine(vectors[i], right[j])  # alike wherever a row stands in its block, so ties are ties
                order = np.lexsort((ids[j], -exact, i))
                i, j, exact = i[order], j[order], exact[order]
                best = np.arange(len(i)) - np.searchsorted(i, i) < k
                found[0].append(np.stack([own[i[best]], ids[j[best]]], axis=1))
                found[1].append(exact[best])
        both = np.concatenate(found[0])
        return pa.table({"query_id": both[:, 0], "vec_id": both[:, 1], "score": np.concatenate(found[1])})

    return run


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 5, share: float = SHARE, cells: int = CELLS
) -> DataFrame:
    """The k nearest rows found for each query: query_id, rank, vec_id, score. Both tables have vec_id and embedding.

    Equal query ids are one query.
    """
    spark = vectors.sparkSession
    rows = usable(vectors)
    wide = rows.agg(F.mode(F.size("vector"))).first()[0]
    if wide is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("vector") == wide)
    kind = rows.schema["vector"].dataType.simpleString()
    drawn = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vector").toArrow()  # at most SAMPLE rows
    sample = halves(unit(matrix(drawn.column("vector").combine_chunks())))
    model = spark.sparkContext.broadcast([fit(s, cells) for s in sample])
    index = keep(rows.mapInArrow(_assign(model), f"id long, vector {kind}, cell int"), "multi-index")
    sizes = index.groupBy("cell").agg(F.count("*").alias("n"))
    counts = np.zeros(cells * cells, np.int64)
    for row in sizes.collect():  # at most cells * cells rows
        counts[row.cell] = row.n
    asked = keep(usable(queries).where(F.size("vector") == wide).dropDuplicates(["id"]), "queries")
    own = index.join(asked.select("id"), "id", "left_semi").groupBy("id").count().agg(F.max("count")).first()[0] or 0
    enough = max(k + own, int(np.ceil(share * counts.sum())))
    sent = spark.sparkContext.broadcast((counts, PART))
    turns = -(-asked.count() // QUERIES) or 1
    turn = F.explode(F.sequence(F.lit(0), F.lit(turns - 1))).alias("turn")  # rows meet the queries in turns of bounded size
    parts = sizes.select("cell", F.ceil(F.col("n") / PART).cast("int").alias("parts"))
    stored = index.join(F.broadcast(parts), "cell").select(
        "cell", F.pmod(F.xxhash64("id", "vector"), "parts").cast("int").alias("part"), turn, "id", "vector"
    )
    probes = asked.mapInArrow(_probe(model, enough, sent), f"id long, vector {kind}, cell int, part int").withColumn(
        "turn", F.pmod(F.xxhash64("id"), F.lit(turns)).cast("int")
    )
    place = ["cell", "part", "turn"]
    met = probes.groupBy(place).cogroup(stored.groupBy(place))
    near = met.applyInArrow(_best(k), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
