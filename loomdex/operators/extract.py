"""Content to text: extraction, page assembly, marker statistics and cleaning jobs."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomdex.functions.text import (
    SECTION_MARKER,
    contains_marker,
    get_cleaner,
    html_to_text,
    is_nonblank,
    section_after_marker,
)

# Messages of the extraction result.
DOWNLOAD_FAILED = "Download failed"
NO_TEXT = "Text extraction failed or text is empty"
STATUS_SUCCESS, STATUS_FAILED, STATUS_ERROR = "success", "failed", "error_in_future"


def _utf8(content: Column) -> Column:
    return F.make_valid_utf8(content.cast("string"))


def _html(content: Column) -> Column:
    return html_to_text(_utf8(content))


# Extractors over a binary Column, evaluated in the JVM.
COLUMN_EXTRACTORS: dict[str, Callable[[Column], Column]] = {"html": _html, "text": _utf8}
# Registered extractors from bytes to text, run on Arrow batches.
BYTE_EXTRACTORS: dict[str, Callable[[bytes], str | None]] = {}


def register_extractor(name: str, extractor: Callable[[bytes], str | None]) -> None:
    BYTE_EXTRACTORS[name.lower()] = extractor


def resolve_extractor(name: str | Callable, fallback: str | None = None):
    """Extractor by name. Unknown names raise, or give ``fallback`` if one is named."""
    if callable(name):
        return name
    key = name.lower()
    for table in (COLUMN_EXTRACTORS, BYTE_EXTRACTORS):
        if key in table:
            return table[key]
    if fallback is None:
        known = sorted([*COLUMN_EXTRACTORS, *BYTE_EXTRACTORS])
        raise ValueError(f"unknown extractor {name!r}; choose from {known}")
    return resolve_extractor(fallback)


def _bytes_udf(extractor: Callable[[bytes], str | None]):
    """(text, error) per document; an exception becomes the error of that row alone."""

    @F.arrow_udf("text string, error string")
    def extract(batch: pa.Array) -> pa.Array:
        texts, errors = [], []
        for data in batch.to_pylist():
            text = error = None
            if data is not None:
                try:
                    text = extractor(data)
                except Exception as exc:  # the row reports it
                    error = str(exc) or type(exc).__name__
            texts.append(text)
            errors.append(error)
        return pa.StructArray.from_arrays(
            [pa.array(texts, type=pa.string()), pa.array(errors, type=pa.string())],
            names=["text", "error"],
        )

    # not deterministic for the optimizer: a filter on the result must not run the extractor twice
    return extract.asNondeterministic()


def extract_text_job(
    df: DataFrame,
    key: str = "motion_id",
    content: str = "content",
    url: str = "url",
    extractor: str | Callable[[bytes], str | None] = "html",
    blank_is_failure: bool = True,
    fallback: str | None = None,
) -> DataFrame:
    """Result row per document: motion_id, status, text, url, content, error_message.

    Missing content fails as not downloaded; empty text fails, and so does white space alone if
    ``blank_is_failure``. An extractor that raises gives ``error_in_future`` and the message.
    Other columns of ``df`` are kept.
    """
    resolved = resolve_extractor(extractor, fallback)
    rest = [c for c in df.columns if c not in (key, content, url)]
    base = df.select(
        F.col(key).cast("string").alias("motion_id"),
        F.col(url).alias("url"),
        F.col(content).cast("binary").alias("content"),
        *rest,
    )
    if resolved in COLUMN_EXTRACTORS.values():
        read = base.withColumns({"_text": resolved(F.col("content")), "_error": F.lit(None).cast("string")})
    else:
        read = base.withColumn("_x", _bytes_udf(resolved)("content")).select(
            "*", F.col("_x.text").alias("_text"), F.col("_x.error").alias("_error")
        ).drop("_x")
    has_text = is_nonblank("_text") if blank_is_failure else F.length("_text") > 0
    missing = F.col("content").isNull()
    usable = F.coalesce(has_text, F.lit(False))
    return read.select(
        "motion_id",
        F.when(missing, STATUS_FAILED)
        .when(F.col("_error").isNotNull(), STATUS_ERROR)
        .when(usable, STATUS_SUCCESS)
        .otherwise(STATUS_FAILED)
        .alias("status"),
        F.when(~missing & usable & F.col("_error").isNull(), F.col("_text")).alias("text"),
        "url",
        "content",
        F.when(missing, DOWNLOAD_FAILED)
        .when(F.col("_error").isNotNull(), F.col("_error"))
        .when(~usable, NO_TEXT)
        .alias("error_message"),
        *rest,
    )


def assemble_pages(
    df: DataFrame, doc: str = "doc", page: str = "page_no", text: str = "text"
) -> DataFrame:
    """Page texts in order, each followed by a line end; a page without text voids the document.

    A document's text is one value, so its pages meet in one task; only page and text travel.
    """
    pages = df.groupBy(doc).agg(
        F.array_sort(F.collect_list(F.struct(F.col(page), F.col(text)))).alias("_pages"),
        F.count_if(F.col(text).isNull()).alias("_holes"),
    )
    joined = F.concat(F.array_join(F.transform("_pages", lambda p: p[text]), "\n"), F.lit("\n"))
    return pages.select(doc, F.when(F.col("_holes") == 0, joined).alias("text"))


def marker_coverage(df: DataFrame, text: str = "text", marker: str = SECTION_MARKER) -> DataFrame:
    """Share of texts with the marker, in percent; null without any text."""
    return df.agg((F.avg(contains_marker(text, marker).cast("double")) * 100).alias("percent"))


def cleaning_counters(df: DataFrame, text: str = "text") -> DataFrame:
    """How many texts were looked at and how many of them had something to clean."""
    return df.agg(
        F.count(F.lit(1)).alias("processed"), F.count_if(is_nonblank(text)).alias("cleaned")
    )


def section_job(
    df: DataFrame, key: str, text: str = "text", marker: str = SECTION_MARKER
) -> DataFrame:
    """(key, text) of the section behind the marker; texts without the marker drop out."""
    cut = df.select(key, section_after_marker(text, marker).alias("text"))
    return cut.where(F.col("text").isNotNull())


def section_counters(df: DataFrame, text: str = "text", marker: str = SECTION_MARKER) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("processed"),
        F.count_if(contains_marker(text, marker)).alias("cleaned"),
    )


def clean_texts_job(
    df: DataFrame,
    filename: str = "filename",
    text: str = "text",
    cleaner: str | Callable[[Column], Column] = "basic",
) -> DataFrame:
    """(filename, status, text): cleaned texts, or ``failed`` where nothing is left."""
    cleaned = df.select(F.col(filename).alias("filename"), get_cleaner(cleaner)(F.col(text)).alias("_t"))
    kept = F.coalesce(F.length("_t") > 0, F.lit(False))
    return cleaned.select(
        "filename",
        F.when(kept, STATUS_SUCCESS).otherwise(STATUS_FAILED).alias("status"),
        F.when(kept, F.col("_t")).alias("text"),
    )
