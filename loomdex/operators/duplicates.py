"""Exact duplicates of rows and of cleaned text, safe for groups of any size."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomdex.functions.text import get_cleaner
from loomdex.session import written

REPEAT_CHUNK = 100_000


def dedup_rows(df: DataFrame) -> DataFrame:
    """Distinct rows, nulls equal. Copies are folded on the map side before the shuffle."""
    return df.dropDuplicates()


def dup_flag_rows(df: DataFrame, out: str = "is_duplicate") -> DataFrame:
    """Every row with a flag that is false once per distinct row and true for each repeat.

    Rows are counted with a map-side combine and written out again from the count, so a row with
    very many copies is never gathered: its copies are produced in chunks spread over the tasks.
    """
    columns = df.columns
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    chunks = counted.withColumn(
        "_chunk",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / REPEAT_CHUNK))),
    ).repartition(F.xxhash64(*columns), F.col("_chunk"))
    first = F.col("_chunk") * REPEAT_CHUNK
    last = F.least(first + REPEAT_CHUNK, F.col("_n")) - 1
    return chunks.select(*columns, F.explode(F.sequence(first, last)).alias("_i")).select(
        *columns, (F.col("_i") > 0).alias(out)
    )


def has_duplicates(df: DataFrame) -> DataFrame:
    """One row: is any row repeated?"""
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return counted.agg(F.coalesce(F.bool_or(F.col("_n") > 1), F.lit(False)).alias("any_duplicate"))


def dedup_clean_text(
    df: DataFrame,
    key: str | Sequence[str],
    text: str = "text",
    status: str = "status",
    cleaner: str | Callable[[Column], Column] = "simple",
) -> DataFrame:
    """Turn ``success`` into ``duplicate`` where an earlier key has the same cleaned text.

    ``key`` names a row among those of one text; rows equal in key and text raise an error, as none of
    them comes first. The rows and the digests of their cleaned texts are written to the shared folder once, however costly
    ``df`` is to make. Repeats are found on (digest, key) alone by combined aggregates, so a text with any number of
    copies loads no single task, and only the narrow list of repeats is joined back, on key and
    digest. The original text is kept in all cases.
    """
    keys = [key] if isinstance(key, str) else list(key)
    eligible = (F.col(status) == "success") & F.col(text).isNotNull()
    digest = F.unhex(F.sha2(get_cleaner(cleaner)(F.col(text)), 256))
    marked = written(df.withColumn("_digest", F.when(eligible, digest)), "marked")
    named = F.struct(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    counted = marked.where("_digest is not null").groupBy(F.col("_digest").alias("_text"), named.alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    firsts = counted.groupBy("_text").agg(F.min("_key").alias("_first"))
    twice = F.raise_error(F.concat(F.lit("rows repeat in key and text: "), F.to_json("_key")))
    checked = F.when(F.col("_n") > 1, twice.cast("boolean")).otherwise(True)
    repeats = counted.join(firsts, "_text").where(checked & (F.col("_key") != F.col("_first")))
    listed = repeats.select("_text", *[F.col(f"_key._k{i}").alias(f"_k{i}") for i in range(len(keys))])
    condition = reduce(
        lambda a, b: a & b,
        [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)],
        F.col("_digest") == F.col("_text"),
    )
    flagged = marked.join(listed, condition, "left").withColumn(
        status, F.when(F.col("_text").isNotNull(), F.lit("duplicate")).otherwise(F.col(status))
    )
    return flagged.select(*df.columns)


def status_summary(df: DataFrame, status: str = "status") -> DataFrame:
    return df.groupBy(status).agg(F.count(F.lit(1)).alias("n"))
