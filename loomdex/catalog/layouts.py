"""Registered queries over page elements."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomdex.catalog import inputs as i
from loomdex.catalog.registry import query
from loomdex.functions.text import format_label
from loomdex.functions.vectors import (
    box_height,
    box_width,
    confident_elements,
    element_colour,
    element_name,
)
from loomdex.operators import layout

ELEMENTS = i.oracle(i.ELEMENTS)
COLOUR = """case type when 0 then 'red' when 1 then 'blue' when 2 then 'green' when 3 then 'purple'
 when 4 then 'orange' when 5 then 'brown' else 'gray' end"""
NAME = """case type when 0 then 'Text' when 1 then 'Title' when 2 then 'List' when 3 then 'Table'
 when 4 then 'Figure' else 'Unknown' end"""
LABEL = "format('Type: {}, Conf: {:.2f}', type, confidence)"
TOP = """select * from (select *, row_number() over (partition by doc, page_number order by confidence desc, element_id) as rank
 from ({src})) where rank <= 5"""
TOP_COLUMNS = ["doc", "page_number", "rank", "element_id", "type", "confidence"]


@query(
    "layout_pages",
    f"""select doc, page_number, count(*) as n, string_agg(cast(type as varchar), ',' order by element_id) as types
 from ({ELEMENTS}) group by doc, page_number""",
)
def layout_pages(spark, folder):
    pages = layout.layout_pages(i.elements(spark, folder))
    return pages.select(
        "doc",
        "page_number",
        F.size("elements").cast("bigint").alias("n"),
        F.array_join(F.transform("elements", lambda e: e["type"].cast("string")), ",").alias("types"),
    )


@query(
    "layout_elements",
    f"""select doc, page_number, row_number() over (partition by doc, page_number order by element_id) - 1 as element_id,
 type, x1, y1, x2, y2, confidence from ({ELEMENTS})""",
)
def layout_elements(spark, folder):
    rows = layout.layout_elements(layout.layout_pages(i.elements(spark, folder)))
    return rows.select(
        "doc", "page_number", F.col("element_id").cast("bigint").alias("element_id"), "type",
        *[F.col(f"coordinates.{c}").alias(c) for c in ("x1", "y1", "x2", "y2")], "confidence",
    )


@query("box_geometry", f"select element_id, x2 - x1 as width, y2 - y1 as height from ({ELEMENTS})")
def box_geometry(spark, folder):
    return i.elements(spark, folder).select(
        "element_id",
        box_width("coordinates").alias("width"),
        box_height("coordinates").alias("height"),
    )


@query(
    "confidence_filter",
    f"select doc, page_number, count(*) filter (confidence >= 0.5) as kept from ({ELEMENTS}) group by 1, 2",
)
def confidence_filter(spark, folder):
    pages = layout.layout_pages(i.elements(spark, folder))
    return pages.select(
        "doc", "page_number", F.size(confident_elements("elements")).cast("bigint").alias("kept")
    )


@query("element_type_label", f"select element_id, {COLOUR} as colour, {NAME} as name from ({ELEMENTS})")
def element_type_label(spark, folder):
    return i.elements(spark, folder).select(
        "element_id", element_colour("type").alias("colour"), element_name("type").alias("name")
    )


@query("format_label", f"select element_id, {LABEL} as label from ({ELEMENTS})")
def label(spark, folder):
    return i.elements(spark, folder).select(
        "element_id", format_label(F.col("type").cast("string"), "confidence").alias("label")
    )


@query("topk_by_confidence", f"select {', '.join(TOP_COLUMNS)} from ({TOP.format(src=ELEMENTS)})")
def topk_by_confidence(spark, folder):
    return layout.topk_by_confidence(i.elements(spark, folder)).select(*TOP_COLUMNS)


@query(
    "layout_report",
    f"""select {', '.join(TOP_COLUMNS)}, x2 - x1 as width, y2 - y1 as height, {COLOUR} as colour,
 {NAME} as type_name, {LABEL} as label, doc || '_page_' || page_number || '.png' as image
 from ({TOP.replace('{src}', f'select * from ({ELEMENTS}) where confidence >= 0.5')})""",
)
def layout_report(spark, folder):
    found = i.elements(spark, folder).withColumn(
        "path", F.concat(F.lit("/data/"), F.col("doc").cast("string"), F.lit(".pdf"))
    )
    report = layout.layout_report(found, path="path")
    return report.select(
        *TOP_COLUMNS, "width", "height", "colour", "type_name", "label", "image"
    )
