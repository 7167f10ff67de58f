"""Connected components of an edge table, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegrade.llm.common import cut_lineage


def _digest(edges: DataFrame) -> tuple:
    """Count and order-free hash sum of an edge table."""
    return tuple(edges.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component: smallest node.

    Alternates two star rewrites until nothing changes: each node hangs its
    larger neighbours on its smallest neighbour, then its smaller ones. Every
    round is one aggregate on map-side-combined minima and one join, which
    adaptive execution splits where a node is hot; no neighbour list is ever
    gathered. Rounds grow with the logarithm of the longest path.
    """
    edges = cut_lineage(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v").distinct()
    )
    while True:
        # larger neighbours of each node move to its smallest neighbour
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.where("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        )
        # smaller neighbours of each node, and the node, move to the smallest
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = cut_lineage(
            large.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(smallest.select("u", F.col("m").alias("v")))
            .where("u <> v").distinct()
        )
        same = _digest(small) == _digest(edges)
        edges = small
        if same:
            break
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component")))
