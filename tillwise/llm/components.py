"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import land


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b) that is not itself a root.

    The root is the smallest node reachable. Each round rewrites the links by two grouped joins and
    lands them; only a row count and a checksum reach the driver. Loops are ignored; no links give
    no rows. Groups are never gathered: a round takes the minimum of a node's neighbours by a
    partial aggregate and joins it back.
    """
    a, b = F.col("a"), F.col("b")
    edges = land(
        links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    )
    seen = _checksum(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        parents = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(parents, "u")
        edges = land(
            small.where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(parents.select("u", F.col("m").alias("v")))
            .distinct()
        )
        now = _checksum(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _checksum(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return tuple(row)
