"""Connected components of an edge table, by alternating large-star and small-star steps.

Each step moves edges towards the smallest node of a neighbourhood; after O(log) rounds every
component is a star around its smallest node.  Edges stay in tables throughout; only their number
and a checksum, to see that nothing changes any more, reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node of its neighbourhood."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    moved = both.join(least, both["a"] == least["u"]).where(F.col("b") > F.col("u"))
    return moved.select(F.col("m").alias("a"), "b").where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them (edges have a < b)."""
    least = edges.groupBy("b").agg(F.min("a").alias("m")).select(F.col("b").alias("v"), "m")
    moved = edges.join(least, edges["b"] == least["v"]).select("a", "b", "m")
    kept = moved.select(F.col("m").alias("a"), F.col("a").alias("b")).union(moved.select(F.col("m").alias("a"), "b"))
    return kept.where("a <> b").distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, label): label is the smallest node of the node's component; only nodes with an edge.

    Self-loops, repeated edges and either direction are fine; an empty table has no nodes.
    """
    now = materialise(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    before = None
    for _ in range(rounds):
        now = materialise(_small_star(_large_star(now)), "edges")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("b").alias("node"), F.col("a").alias("label")).union(
        now.select(F.col("a").alias("node"), F.col("a").alias("label"))).distinct()
