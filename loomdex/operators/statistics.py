"""Token statistics as a state that merges: counts, document counts and first uses from one pass over the texts.

A state has one row per token: how often it occurs (n), in how many documents (df), and where it was first used, as the
least (key, position). The row of the null token counts the documents. States of disjoint sets of documents add up, so the
statistics of a growing corpus never need its old texts again.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomdex.functions.embedding import list_parts

STATE = ["token", "n", "df", "first"]
HELD_ROWS = 1 << 18  # rows of parts that a task holds before it merges them


def _first_of_each(group: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each value of ``group`` that occurs, the place where ``order`` is least."""
    place = np.lexsort((order, group))
    sorted_group = group[place]
    return place[np.r_[True, sorted_group[1:] != sorted_group[:-1]]] if len(place) else place


def _counted(batch: pa.RecordBatch, key_type: pa.DataType) -> pa.RecordBatch:
    """The state of a part of a batch of (key, tokens)."""
    key, lists = batch.column(0), batch.column(1)
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(lists)), sizes)
    words = lists.flatten().dictionary_encode()
    token = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    kinds = len(words.dictionary)
    pairs, place = np.unique(row * max(kinds, 1) + token, return_index=True)  # each token of a row once, at its first place
    own = pairs % max(kinds, 1)
    rank = np.empty(len(key), np.int64)
    rank[pc.sort_indices(key, null_placement="at_start").to_numpy()] = np.arange(len(key))
    # equal keys of several rows: the lower place counts, as in one long row
    rank = rank if len(key) == pc.count_distinct(key, mode="all").as_py() else _dense_rank(key, rank)
    position = place - (np.cumsum(sizes) - sizes)[row[place]]
    first = _first_of_each(own, rank[row[place]] * (int(position.max(initial=0)) + 1) + position)
    columns = [
        pa.concat_arrays([words.dictionary.cast(pa.string()), pa.nulls(1, pa.string())]),
        pa.array(np.r_[np.bincount(token, minlength=kinds), len(key)].astype(np.int64)),
        pa.array(np.r_[np.bincount(own, minlength=kinds), len(key)].astype(np.int64)),
        pa.concat_arrays([key.take(pa.array(row[place][first])).cast(key_type), pa.nulls(1, key_type)]),
        pa.array(np.r_[position[first], 0].astype(np.int32)),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["token", "n", "df", "key", "pos"])


def _merged(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    """One state from those of several parts, as :func:`merged_states` gives."""
    if len(parts) == 1:
        return parts[0]
    rows = pa.concat_batches(parts)
    order = pc.sort_indices(rows, sort_keys=[("key", "ascending"), ("pos", "ascending")], null_placement="at_start")
    rows = rows.take(order)
    token = rows.column("token").dictionary_encode(null_encoding="encode").indices.to_numpy()
    _, place = np.unique(token, return_index=True)  # the first place of each: its least (key, pos)
    totals = []
    for name in ("n", "df"):
        total = np.zeros(len(place), np.int64)
        np.add.at(total, token, rows.column(name).to_numpy())
        totals.append(pa.array(total))
    token, key, pos = (rows.column(c).take(pa.array(place)) for c in ("token", "key", "pos"))
    return pa.RecordBatch.from_arrays([token, *totals, key, pos], names=parts[0].schema.names)


def _dense_rank(key: pa.Array, rank: np.ndarray) -> np.ndarray:
    codes = key.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    least = np.full(int(codes.max()) + 1, len(rank))
    np.minimum.at(least, codes, rank)
    return least[codes]


def token_state(df: DataFrame, key: str, tokens: str = "tokens") -> DataFrame:
    """Rows (token, n, df, first) of all rows of ``df``. Arrow batches are counted in parts of bounded size, which
    are merged as they get many, so what is shuffled is a row per token and large part at most."""
    kind = df.schema[key].dataType
    fields = [("token", T.StringType()), ("n", T.LongType()), ("df", T.LongType()), ("key", kind), ("pos", T.IntegerType())]
    from pyspark.sql.pandas.types import to_arrow_type

    key_type = to_arrow_type(kind)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for start, end in list_parts(batch.column(1)):
                held.append(_counted(batch.slice(start, end - start), key_type))
                if sum(h.num_rows for h in held) >= HELD_ROWS:
                    held = [_merged(held)]
                    if held[0].num_rows >= HELD_ROWS // 2:
                        yield held.pop()
        if held:
            yield _merged(held)

    schema = T.StructType([T.StructField(n, t) for n, t in fields])
    parts = df.select(F.col(key).alias("key"), F.col(tokens).alias("tokens")).mapInArrow(count, schema)
    return merged_states(parts.select("token", "n", "df", F.struct("key", "pos").alias("first")))


def merged_states(*states: DataFrame) -> DataFrame:
    """The state of several disjoint sets of documents."""
    rows = reduce(DataFrame.unionByName, [s.select(*STATE) for s in states])
    return rows.groupBy("token").agg(F.sum("n").alias("n"), F.sum("df").alias("df"), F.min("first").alias("first"))


def documents_of(state: DataFrame) -> Column:
    """How many documents a state covers, as a one-value subquery."""
    return state.where("token is null").agg(F.coalesce(F.sum("df"), F.lit(0))).scalar()
