"""Vector expressions over array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def vector_prefix(c: Column | str, n: int) -> Column:
    return F.slice(_col(c), 1, n)


def dot_product(a: Column | str, b: Column | str) -> Column:
    products = F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def vector_norm(c: Column | str) -> Column:
    return F.sqrt(
        F.aggregate(
            _col(c), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")
        )
    )


def cosine_similarity(a: Column | str, b: Column | str) -> Column:
    """Cosine in double precision; 0 when either vector is all zeros."""
    scale = vector_norm(a) * vector_norm(b)
    return F.when(scale > 0, dot_product(a, b) / scale).otherwise(F.lit(0.0))


def unit_vector(c: Column | str) -> Column:
    """Vector of length one as floats; all-zero vectors stay as they are."""
    # the one-element transform names the norm, so it is computed once and not per element
    scaled = F.transform(
        F.array(vector_norm(c)),
        lambda n: F.transform(
            _col(c), lambda x: F.when(n > 0, x.cast("double") / n).otherwise(F.lit(0.0)).cast("float")
        ),
    )
    return scaled[0]


INT8_LEVELS = 127


def int8_encode(c: Column | str, low: Column, high: Column) -> Column:
    """Codes 0..127 for values between ``low`` and ``high`` (values outside are clipped)."""
    bounds = F.struct(low.cast("double").alias("lo"), high.cast("double").alias("hi"))
    coded = F.transform(
        F.array(bounds),
        lambda b: F.transform(
            _col(c),
            lambda x: F.when(
                b["hi"] > b["lo"],
                F.floor(
                    (F.least(F.greatest(x.cast("double"), b["lo"]), b["hi"]) - b["lo"])
                    / (b["hi"] - b["lo"])
                    * INT8_LEVELS
                    + 0.5
                ),
            )
            .otherwise(F.lit(0))
            .cast("tinyint"),
        ),
    )
    return coded[0]


def int8_decode(codes: Column | str, low: Column, high: Column) -> Column:
    bounds = F.struct(low.cast("double").alias("lo"), high.cast("double").alias("hi"))
    values = F.transform(
        F.array(bounds),
        lambda b: F.transform(
            _col(codes), lambda q: b["lo"] + q.cast("double") / INT8_LEVELS * (b["hi"] - b["lo"])
        ),
    )
    return values[0]


# Geometry and labels of page elements -----------------------------------------------------

# Element codes with their drawing colours; anything else is drawn gray.
ELEMENT_COLOURS = {0: "red", 1: "blue", 2: "green", 3: "purple", 4: "orange", 5: "brown"}
ELEMENT_NAMES = {0: "Text", 1: "Title", 2: "List", 3: "Table", 4: "Figure", 5: "Unknown"}
DEFAULT_COLOUR = "gray"


def box_width(box: Column | str) -> Column:
    return _col(box)["x2"] - _col(box)["x1"]


def box_height(box: Column | str) -> Column:
    return _col(box)["y2"] - _col(box)["y1"]


def _lookup(code: Column, table: dict[int, str]) -> Column:
    entries = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), code.cast("int"))


def element_colour(code: Column | str) -> Column:
    return F.coalesce(_lookup(_col(code), ELEMENT_COLOURS), F.lit(DEFAULT_COLOUR))


def element_name(code: Column | str) -> Column:
    return F.coalesce(_lookup(_col(code), ELEMENT_NAMES), F.lit("Unknown"))


def confident_elements(elements: Column | str, threshold: float = 0.5) -> Column:
    return F.filter(_col(elements), lambda e: e["confidence"] >= threshold)
