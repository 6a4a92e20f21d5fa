"""Page elements found by a layout detector: grouping, filtering, geometry and ranking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomdex.functions.text import format_label, page_image_name
from loomdex.functions.vectors import (
    box_height,
    box_width,
    element_colour,
    element_name,
)
from loomdex.operators.relational import top_per_group

ELEMENT = ["type", "coordinates", "confidence"]
MIN_CONFIDENCE = 0.5
TOP_ELEMENTS = 5


def layout_pages(
    elements: DataFrame, doc: str = "doc", page: str = "page_number", order: str = "element_id"
) -> DataFrame:
    """One row per page with its elements in detector order."""
    entry = F.struct(order, *ELEMENT)
    grouped = elements.groupBy(doc, page).agg(F.array_sort(F.collect_list(entry)).alias("_e"))
    plain = F.transform("_e", lambda e: F.struct(*[e[f].alias(f) for f in ELEMENT]))
    return grouped.select(doc, page, plain.alias("elements"))


def layout_elements(pages: DataFrame) -> DataFrame:
    """One row per element again, numbered from 0 within its page."""
    rest = [c for c in pages.columns if c != "elements"]
    exploded = pages.select(*rest, F.posexplode("elements").alias("element_id", "_e"))
    return exploded.select(*rest, "element_id", "_e.*")


def confidence_filter(elements: DataFrame, threshold: float = MIN_CONFIDENCE) -> DataFrame:
    return elements.where(F.col("confidence") >= threshold)


def describe_elements(
    elements: DataFrame, path: str | None = None, page: str = "page_number"
) -> DataFrame:
    """Add box size, colour, name and label, and the page image name if ``path`` is a column."""
    added = {
        "width": box_width("coordinates"),
        "height": box_height("coordinates"),
        "colour": element_colour("type"),
        "type_name": element_name("type"),
        "label": format_label(F.col("type").cast("string"), "confidence"),
    }
    if path:
        added["image"] = page_image_name(path, page)
    return elements.withColumns(added)


def topk_by_confidence(
    elements: DataFrame,
    k: int = TOP_ELEMENTS,
    group: Sequence[str] = ("doc", "page_number"),
    order: str = "element_id",
) -> DataFrame:
    """The k surest elements per page; equal confidence keeps detector order."""
    return top_per_group(elements, group, [F.desc("confidence"), F.asc(order)], k)


def layout_report(
    elements: DataFrame,
    threshold: float = MIN_CONFIDENCE,
    k: int = TOP_ELEMENTS,
    path: str | None = None,
    group: Sequence[str] = ("doc", "page_number"),
) -> DataFrame:
    """Described elements above the threshold that are among the k surest of their page."""
    kept = topk_by_confidence(confidence_filter(elements, threshold), k, group)
    return describe_elements(kept, path)
