"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "loomdex", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution on; a cluster's own settings stay in force.

    Partition counts are left to AQE: a high initial number that is coalesced by size.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir`` or a checkpoint folder set later."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder.rstrip("/")


_made: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """Fresh path below the shared folder. Results read from it lazily, so it stays until :func:`clear_scratch`."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete all that this driver has written to fresh paths, once its results have been used; returns how many."""
    gone = sum(remove_path(spark, path) for path in _made)
    _made.clear()
    return gone


def written(df: DataFrame, label: str, *partitions: str) -> DataFrame:
    """The same rows read back from a new table in the shared folder."""
    path = scratch_path(df.sparkSession, label)
    df.write.partitionBy(*partitions).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a path on whichever file system it lives; False if it was not there."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(target, True))
