"""Keyword ranking over an inverted index: posting lists in shards, with a maximum per block, and pruned top lists.

The index has one row per shard and vocabulary entry: the documents of the shard that have it, as rising positions, their
weights, and the largest weight of each ``BLOCK`` of them; and one row per shard with its ids in order. Documents are dealt
to shards by hash, so that a word of every document is as many lists as there are shards, each of bounded size.

A search reads the lists of the asked words only. Within a shard a query's lists are added up from the one that can give
most; once what is left can't lift an unseen document over the query's worst kept score, the rest is looked up for the
documents seen only, and for these only in blocks whose maximum still matters. Rows that score 0 fill up by the
smallest ids, which are the first positions that no list has; no vector is read for it. Results are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomdex.operators.scan import QUERY_BYTES, QUERY_ROWS, Branch, Stage, _arrow_schema, _finish
from loomdex.session import written

SHARD_ROWS = 1 << 14
SHARD_ENTRIES = 1 << 20  # a task sorts the entries of a whole shard at a time
BLOCK = 128
IDS = -1  # in place of a vocabulary entry: the row that holds the shard's ids
MARGIN = 1e-7  # scores are rounded, so a bound must exceed by more than that


def _schema(id_type: T.DataType) -> T.StructType:
    fields = [("shard", T.IntegerType()), ("idx", T.IntegerType()), ("ids", T.ArrayType(id_type))]
    fields += [("docs", T.BinaryType()), ("weights", T.BinaryType()), ("most", T.BinaryType())]
    return T.StructType([T.StructField(n, t) for n, t in fields])


def _lists(shard: int, rows: pa.Table, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The index rows of one shard from its rows (id, vector)."""
    rows = rows.sort_by("id").combine_chunks()
    vectors = rows.column("vector").combine_chunks()
    indices = vectors.field("indices")
    idx = indices.flatten().to_numpy(zero_copy_only=False)
    weight = vectors.field("values").flatten().to_numpy(zero_copy_only=False)
    sizes = indices.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    doc = np.repeat(np.arange(len(rows), dtype=np.int32), sizes)
    order = np.argsort(idx, kind="stable")
    idx, weight, doc = idx[order], weight[order], doc[order]
    start = np.flatnonzero(np.r_[True, idx[1:] != idx[:-1]]) if len(idx) else np.zeros(0, np.int64)
    end = np.r_[start[1:], len(idx)]
    out = [(shard, IDS, rows.column("id").to_pylist(), None, None, None)]
    for a, b in zip(start, end[: len(start)]):
        most = np.maximum.reduceat(weight[a:b], np.arange(0, b - a, BLOCK))
        out.append((shard, int(idx[a]), None, doc[a:b].tobytes(), weight[a:b].tobytes(), most.tobytes()))
    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """Whole shards of batches that are sorted by shard."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        shards = batch.column("shard").to_numpy()
        cuts = np.flatnonzero(np.r_[True, shards[1:] != shards[:-1]]) if len(shards) else []
        for a, b in zip(cuts, [*cuts[1:], len(shards)]):
            part = batch.slice(a, b - a)
            if held and held[0].column("shard")[0].as_py() != part.column("shard")[0].as_py():
                yield held[0].column("shard")[0].as_py(), pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield held[0].column("shard")[0].as_py(), pa.Table.from_batches(held)


def build_postings(vectors: DataFrame, vector: str = "text_sparse", shard_rows: int = SHARD_ROWS, shard_entries: int = SHARD_ENTRIES) -> DataFrame:
    """The index of rows (id, struct of indices and values), written to the shared folder. Ids must be different.

    There are as many shards as keep their mean within ``shard_rows`` rows and ``shard_entries`` list entries.
    """
    rows = written(vectors.select("id", F.col(vector).alias("vector")), "sparse-vectors")
    size = rows.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size("vector.indices")).alias("entries")).first()
    shards = max(1, -(-size["rows"] // shard_rows), -(-(size["entries"] or 0) // shard_entries))
    schema = _schema(rows.schema["id"].dataType)
    target = _arrow_schema(schema)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, table in _by_shard(batches):
            yield from _lists(shard, table.select(["id", "vector"]), target)

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    dealt = dealt.repartition("shard").sortWithinPartitions("shard")
    return written(dealt.mapInArrow(build, schema).sortWithinPartitions("shard", "idx"), "postings")


class _Shard:
    """The asked lists of one shard."""

    def __init__(self, rows: pa.Table, columns: int):
        self.lists: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for idx, docs, weights, most, ids in zip(*(rows.column(c).to_pylist() for c in ("idx", "docs", "weights", "most", "ids"))):
            if idx == IDS:
                self.ids = pa.array(ids, rows.schema.field("ids").type.value_type)
            else:
                self.lists[idx] = (np.frombuffer(docs, np.int32), np.frombuffer(weights), np.frombuffer(most))
        self.total = np.zeros(len(self.ids))

    def best(self, asked: list[tuple[int, float]], k: int, floor: float, zeros: bool, digits: int):
        """Positions and scores of a query's best documents, and how many list entries were added."""
        terms = []
        for idx, weight in asked:
            if idx in self.lists and weight:
                docs, weights, most = self.lists[idx]
                bound = most * weight if weight > 0 else np.full(len(most), weight * weights.min())
                terms.append((float(bound.max()), docs, weights * weight, bound))
        terms.sort(key=lambda t: -t[0])
        rest = np.cumsum([0.0, *(max(t[0], 0.0) for t in reversed(terms))])[::-1]  # what terms n.. can add at most
        rising = all(t[2].min() >= 0 for t in terms)
        seen, work = np.zeros(0, np.int32), 0
        closed = False
        for n, (_, docs, value, bound) in enumerate(terms):
            if not closed and rising and len(seen) >= k:
                reached = self.total[seen]
                floor = max(floor, float(np.partition(reached, len(reached) - k)[len(reached) - k]))
            if rising and rest[n] < floor - MARGIN:
                closed = True
                seen = seen[self.total[seen] + rest[n] >= floor - MARGIN]
                place = np.searchsorted(docs, seen)
                block = np.minimum(place, len(docs) - 1) // BLOCK
                useful = self.total[seen] + bound[block] + rest[n + 1] >= floor - MARGIN
                place, at = place[useful], seen[useful]
                hit = (place < len(docs)) & (docs[np.minimum(place, len(docs) - 1)] == at)
                self.total[at[hit]] += value[place[hit]]
                work += len(at)
            else:
                self.total[docs] += value
                seen = np.union1d(seen, docs)
                work += len(docs)
        score = np.round(self.total[seen], digits) + 0.0
        if rising and np.count_nonzero(score > 0) >= k or not zeros:
            kept = score != 0
            position, score = seen[kept], score[kept]
        else:  # nothing was left out: no document reaches the floor that others set, or there is none
            none = np.setdiff1d(np.arange(min(len(self.ids), len(seen) + k)), seen)[:k]
            position, score = np.r_[seen, none].astype(np.int64), np.r_[score, np.zeros(len(none))]
        for _, docs, _, _ in terms:
            self.total[docs] = 0.0
        order = np.lexsort((position, -score))[:k]
        return position[order], score[order], work


def sparse_topk_postings(
    index: DataFrame, queries: DataFrame, k: int, include_zero: bool = True, vector: str = "text_sparse", digits: int = 9
) -> DataFrame:
    """Best ``k`` documents (qid, id, score, rank) per query (qid, struct of indices and values) by dot product."""
    id_type = index.schema["ids"].dataType.elementType
    fields = [("branch", T.StringType()), ("qid", queries.schema["qid"].dataType), ("id", id_type), ("s1", T.DoubleType())]
    schema = T.StructType([T.StructField(n, t) for n, t in fields])
    asked = queries.select("qid", F.col(f"{vector}.indices").alias("indices"), F.col(f"{vector}.values").alias("values"))
    size = asked.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("indices")).alias("widest")).first()
    blocks = -(-size["n"] // max(1, min(QUERY_ROWS, QUERY_BYTES // (12 * max(size["widest"] or 1, 1)))))
    if blocks > 1:
        asked = written(asked, "queries")
    target = _arrow_schema(schema)
    found = index.sparkSession.createDataFrame([], schema)
    for b in range(blocks):
        held = asked.where(F.pmod(F.xxhash64("qid"), F.lit(blocks)) == b).toArrow()  # bounded in rows and bytes
        words = asked.select(F.explode("indices").alias("idx")).distinct()
        lists = index.join(words, "idx", "left_semi").unionByName(index.where(F.col("idx") == IDS))
        lists = lists.repartition("shard").sortWithinPartitions("shard")
        found = found.union(lists.mapInArrow(_search(held, k, include_zero, digits, target), schema))
    return _finish(found, [Branch("sparse", vector, (Stage(k),))], 1).drop("branch")


def _search(held: pa.Table, k: int, zeros: bool, digits: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = [list(zip(i or [], v or [])) for i, v in zip(held.column("indices").to_pylist(), held.column("values").to_pylist())]
        qids = held.column("qid").combine_chunks()
        top = [np.zeros(0)] * len(wanted)  # scores kept so far, over this task's shards
        for _, rows in _by_shard(batches):
            shard = _Shard(rows, len(wanted))
            found, number, scores = [], [], []
            for q, terms in enumerate(wanted):
                floor = float(top[q][-1]) if len(top[q]) == k else -np.inf
                position, score, _ = shard.best(terms, k, floor, zeros, digits)
                top[q] = np.sort(np.r_[top[q], score])[::-1][:k]
                found.append(position)
                number.append(np.full(len(position), q))
                scores.append(score)
            if found:
                where, number = np.concatenate(found).astype(np.int64), np.concatenate(number).astype(np.int64)
                columns = [pa.array(["sparse"] * len(where), pa.string()), qids.take(pa.array(number)), shard.ids.take(pa.array(where)), pa.array(np.concatenate(scores))]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return run
