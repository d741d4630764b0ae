"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a, b``); the component is its smallest node.

    Each round maps a node to the smallest of itself and its neighbours, twice, and draws
    the edges anew between what is left; a node with very many neighbours is one sum before
    and after the shuffle. Rounds grow with the logarithm of the longest path."""
    edge = edges.where("a <> b")
    both = stored(edge.select("a", "b").union(edge.select("b", "a")).distinct())
    found = None
    while True:
        nearest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("p"))
        parent = stored(
            nearest.alias("x").join(nearest.alias("y"), F.col("x.p") == F.col("y.a")).select("x.a", "y.p")
        )
        if found is None:
            found = parent.select(F.col("a").alias("node"), F.col("p").alias("component"))
        else:
            found = stored(
                found.join(parent, F.col("component") == F.col("a"), "left").select(
                    "node", F.coalesce("p", "component").alias("component")
                )
            )
        ends = both.join(parent.select("a", F.col("p").alias("pa")), "a").join(
            parent.select(F.col("a").alias("b"), F.col("p").alias("pb")), "b"
        )
        both = stored(ends.where("pa <> pb").select(F.col("pa").alias("a"), F.col("pb").alias("b")).distinct())
        if both.isEmpty():
            return found
