"""Connected components of a link table, by alternating large-star and small-star steps.

Every step is a grouped minimum and a join, so a node with very many links is pre-aggregated and its join side can be split. A
round is written to the shared folder, which cuts the lineage and lets a lost executor's work be redone from there. The number
of rounds grows with the logarithm of the number of nodes; only a row count and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweft.llm.common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the larger (or the smaller and itself) neighbours of each node to the smallest of node and neighbours."""
    near = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    lowest = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = near.join(lowest, "u")
    if large:
        out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(lowest.select("u", F.col("m").alias("v")))
    return out.filter(F.col("u") != F.col("v")).distinct()


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """node and component (the smallest node reachable) for every node that has a link to another node."""
    pair = links.select(F.col(left).cast("long").alias("a"), F.col(right).cast("long").alias("b")).filter("a <> b")
    edges = written(pair.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    while True:
        # In an edge u > v, so the small-star step reads each node's smaller neighbours.
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
        edges = written(_star(_star(edges, large=True), large=False), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select("v", "v").distinct())
