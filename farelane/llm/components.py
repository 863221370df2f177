"""Connected components of a graph held in a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.llm.common import land


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for each node of ``edges`` (columns a, b): label is the least node reachable.

    Alternating large-star and small-star steps, each a minimum per node and a join. The
    edges are written to the shared folder after each round; rounds grow with the
    logarithm of the graph. An empty table of edges gives an empty result.
    """

    def least(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))

    def both(e: DataFrame) -> DataFrame:
        return e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    # Edges are kept as a > b.
    now = land(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "graph"
    )
    seen = None
    while (found := state(now)) != seen:
        seen = found
        pairs = both(now)
        # Large star: greater neighbours move to the least neighbour.
        large = pairs.where("v > u").join(least(pairs), "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # Small star: lesser neighbours and the node itself move to the least neighbour.
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        low = least(down)
        small = down.join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
        now = land(small.where("a <> b").distinct(), "graph")
    leaves = now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
    return leaves.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
