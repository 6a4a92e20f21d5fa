"""Writers for tables and for documents routed by their status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Area a document goes to by status; other statuses are not kept.
AREAS = {"success": "extracted", "duplicate": "duplicates"}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header CSV without an index column, one part file per task; nulls are empty fields."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("quoteAll", False)
        .option("emptyValue", '""')
        .csv(path)
    )


def routed(df: DataFrame, status: str = "status") -> DataFrame:
    """Rows that are kept, with the ``area`` of their status."""
    pairs = [F.lit(x) for pair in AREAS.items() for x in pair]
    area = F.try_element_at(F.create_map(*pairs), F.col(status))
    return df.withColumn("area", area).where(F.col("area").isNotNull())


def write_text_by_key(
    df: DataFrame, path: str, key: str = "motion_id", text: str = "text", mode: str = "overwrite"
) -> None:
    """Texts below ``area=extracted`` and ``area=duplicates``; the key stays a column."""
    routed(df).select(key, text, "area").write.mode(mode).partitionBy("area").parquet(path)


def write_binary_by_key(
    df: DataFrame, path: str, key: str = "motion_id", content: str = "content", mode: str = "overwrite"
) -> None:
    """Original bytes with the same routing as the texts."""
    kept = routed(df).where(F.col(content).isNotNull())
    kept.select(key, content, "area").write.mode(mode).partitionBy("area").parquet(path)
