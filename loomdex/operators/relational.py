"""Joins, filters and projections over the business and document tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomdex.functions.text import is_nonblank
from loomdex.operators.skew import salted_join

ITEM_KEY = "geschaeft_uid"
DOC_ITEM_KEY = "dokument_geschaeft_uid"
ITEM_TYPE = "Motion"
DOC_TYPES = ("Vorstosstext", "Vorstoss")
URL_MISSING = "URL not found for motion_id"


def with_suffixes(
    left: DataFrame, right: DataFrame, suffixes: tuple[str, str] = ("_x", "_y")
) -> tuple[DataFrame, DataFrame]:
    """Rename columns that both sides have, so that a join result has unique names."""
    shared = set(left.columns) & set(right.columns)
    return (
        left.withColumnsRenamed({c: c + suffixes[0] for c in shared}),
        right.withColumnsRenamed({c: c + suffixes[1] for c in shared}),
    )


def merge_documents(
    docs: DataFrame,
    items: DataFrame,
    left_on: str = DOC_ITEM_KEY,
    right_on: str = ITEM_KEY,
    null_safe: bool = True,
) -> DataFrame:
    """Documents with their business item; both keys stay, and null keys match each other."""
    left, right = with_suffixes(docs, items)
    left_on = left_on if left_on in left.columns else left_on + "_x"
    right_on = right_on if right_on in right.columns else right_on + "_y"
    return salted_join(left, right, [(left_on, right_on)], "inner", null_safe)


def filter_motions(
    df: DataFrame, item_type: str = ITEM_TYPE, doc_types: Sequence[str] = DOC_TYPES
) -> DataFrame:
    """Motions with a motion text. Null types fail the comparison and go."""
    return df.where(
        (F.col("geschaeft_typ_deutsch") == item_type)
        & F.col("dokument_typ_deutsch").isin(*doc_types)
    )


def localized_fields(df: DataFrame, target: str = "dokument_ziel_publikation") -> DataFrame:
    """Title and decision in the language of publication; German wins when both are named."""
    german = F.contains(F.col(target), F.lit("Deutsch"))
    french = F.col(target) == "Französisch"

    def pick(field: str):
        return F.when(german, F.col(f"geschaeft_{field}_deutsch")).when(
            french, F.col(f"geschaeft_{field}_franz")
        )

    return df.withColumns({"title": pick("titel"), "beschluss": pick("beschluss")})


def success_filter(df: DataFrame, status: str = "status", text: str = "text") -> DataFrame:
    return df.where((F.col(status) == "success") & (F.length(text) > 0))


def nonblank_filter(df: DataFrame, text: str = "text") -> DataFrame:
    return df.where(is_nonblank(text))


def cast_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.withColumns({k: F.col(k).cast("string") for k in keys})


def payload_struct(df: DataFrame, fields: Sequence[str], out: str = "payload") -> DataFrame:
    return df.withColumn(out, F.struct(*fields))


def sample_head(df: DataFrame, samples: int | str, order: Sequence[str]) -> DataFrame:
    """First ``samples`` rows by ``order``; 0 or "all" keeps every row."""
    if isinstance(samples, str):
        if samples == "all":
            samples = 0
        elif samples.isdigit():
            samples = int(samples)
        else:
            raise ValueError(f"samples must be a count or 'all', not {samples!r}")
    if samples < 0:
        raise ValueError("samples must not be negative")
    return df.orderBy(*order).limit(samples) if samples else df


def keyed_url_lookup(
    df: DataFrame,
    rows: DataFrame,
    key: str,
    url: str = "url",
    order: str = "ord",
    out: str = "url",
    default: str = URL_MISSING,
) -> DataFrame:
    """Attach the last url seen per key; keys without one get the default text."""
    latest = rows.groupBy(F.col(key).alias("_lookup_key")).agg(
        F.max_by(url, order).alias("_lookup_url")
    )
    joined = salted_join(df, latest, [(key, "_lookup_key")], "left")
    return joined.withColumn(out, F.coalesce("_lookup_url", F.lit(default))).drop(
        "_lookup_key", "_lookup_url"
    )


def search_result_rows(
    hits: DataFrame, fields: Sequence[str] = ("title", "beschluss", "url")
) -> DataFrame:
    """One printable row per hit: query, 1-based rank, score and payload fields."""
    return hits.select(
        "qid", "rank", "score", *[F.col(f"payload.{f}").alias(f) for f in fields]
    )


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence, k: int, rank: str = "rank"
) -> DataFrame:
    """Top k rows per group. Spark prunes each task to k rows per group before the shuffle."""
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window).cast("bigint")).where(F.col(rank) <= k)
