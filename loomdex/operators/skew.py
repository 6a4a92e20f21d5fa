"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    how: str = "inner",
    null_safe: bool = False,
    salts: int = 1,
) -> DataFrame:
    """Equi-join whose left side may have hot keys.

    Adaptive execution splits large partitions of a join by itself. Where its result must keep a
    partitioning, or a key's rows are too many for one task all the same, ``salts`` deals the left
    rows of every key into that many parts, by a hash of the whole row, and repeats the right
    rows for each part. The parts do not depend on how the left side is partitioned already.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join repeats right rows, so it supports inner and left joins only")
    if salts < 1:
        raise ValueError("salts must be positive")
    pairs = []
    if salts > 1:
        left = left.withColumn("_salt_l", F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int"))
        right = right.withColumn("_salt_r", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        pairs = [left["_salt_l"] == right["_salt_r"]]
    pairs += [left[a].eqNullSafe(right[b]) if null_safe else left[a] == right[b] for a, b in on]
    return left.join(right, reduce(lambda x, y: x & y, pairs), how).drop("_salt_l", "_salt_r")
