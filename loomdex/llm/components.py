"""Connected components of links, as joins and grouped minima until nothing changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomdex.llm.common import keep


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """Rows (node, root) of all nodes in ``links`` (u, v); root is the smallest node of the component.

    Alternates two steps: larger neighbours of a node are linked to its smallest neighbour, then smaller ones
    (and the node itself) are. Both keep the components and end in stars. Neighbours are never gathered: each
    step is a grouped minimum, combined before its shuffle, and a join.
    """
    edges = keep(links.where("u <> v").selectExpr("greatest(u, v) as u", "least(u, v) as v").distinct(), "links", narrow=True)
    state = None
    while (now := _state(edges)) != state:
        state = now
        both = edges.union(edges.selectExpr("v as u", "u as v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        edges = keep(both.join(least, "u").where("v > u").selectExpr("v as u", "m as v").where("u <> v").distinct(), "links", narrow=True)
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        small = edges.join(least, "u").selectExpr("v as u", "m as v").where("u <> v")
        edges = keep(small.union(least.selectExpr("u", "m as v")).distinct(), "links", narrow=True)
    return edges.selectExpr("u as node", "v as root").union(edges.selectExpr("v as node", "v as root").distinct())
