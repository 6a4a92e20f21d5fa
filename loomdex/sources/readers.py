"""Readers for tables, text files and binary documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomdex.functions.text import file_name, file_stem


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Column names of the two input tables.
ITEM_SCHEMA = _strings(
    "geschaeft_uid",
    "geschaeft_typ_deutsch",
    "geschaeft_titel_deutsch",
    "geschaeft_titel_franz",
    "geschaeft_beschluss_deutsch",
    "geschaeft_beschluss_franz",
)
DOCUMENT_SCHEMA = _strings(
    "dokument_uid",
    "dokument_geschaeft_uid",
    "dokument_typ_deutsch",
    "dokument_ziel_publikation",
    "dokument_url",
)

# Texts that mean "no value" in a CSV file.
NULL_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def scan_csv(
    spark: SparkSession, path: str, schema: T.StructType, null_words: bool = True, multi_line: bool = True
) -> DataFrame:
    """Header CSV with a declared schema; columns are matched by name.

    Every column is read as text, the null words become null, and then types are cast. Quoted values may
    hold line breaks; without ``multi_line``, for files known to have none, a file is split over tasks.
    """
    options = {"header": True, "multiLine": multi_line, "escape": '"'}
    names = spark.read.options(**options).csv(path).columns
    raw = spark.read.schema(_strings(*names)).options(**options).csv(path)

    def value(field: T.StructField):
        if field.name not in names:
            raise ValueError(f"{path} has no column {field.name}")
        c = F.col(f"`{field.name}`")
        return (F.when(~c.isin(NULL_WORDS), c) if null_words else c).cast(field.dataType).alias(field.name)

    return raw.select(*[value(f) for f in schema.fields])


def scan_text_files(
    spark: SparkSession, folder: str, suffix: str = "txt", keys: Sequence[str] = ()
) -> DataFrame:
    """(filename, text): every file of a folder as one row, named without its suffix.

    ``keys`` names levels of ``key=value`` folders to add as columns.
    """
    files = spark.read.option("pathGlobFilter", f"*.{suffix}").text(folder, wholetext=True)
    return files.select(
        file_stem(F.col("_metadata.file_name")).alias("filename"), F.col("value").alias("text"), *keys
    )


def scan_binary_docs(
    spark: SparkSession, folder: str, suffix: str = "pdf", keys: Sequence[str] = ()
) -> DataFrame:
    """(name, content): every matching file of a folder as bytes, with the ``keys`` of its folders."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{suffix}").load(folder)
    return files.select(file_name("path").alias("name"), "content", *keys)


#: Setting by which a caller asks for inputs spread by key over so many partitions; unset, file splits decide.
PARTITIONS_SETTING = "spark.loomdex.inputPartitions"


def read_parquet(spark: SparkSession, path: str, *spread_by: str) -> DataFrame:
    """A table as its files are split, or spread by key where the caller's session asks for it."""
    df = spark.read.parquet(path)
    wanted = spark.conf.get(PARTITIONS_SETTING, None)
    return df.repartition(int(wanted), *spread_by) if wanted and spread_by else df
