"""Connected components of an undirected graph, on DataFrames alone.

Alternating large-star and small-star steps: every step is a grouped minimum
and a join, so no node's neighbours are ever gathered in one place, and the
edges of a round are written to the shared checkpoint folder.

A hub may have half of all edges.  The edges of a step are distinct by both
ends, a shuffle that spreads a hub over all tasks; the join with the least
neighbours then deals both sides out anew, so adaptive execution splits the
hub (edges that kept the partitioning by node could not be split).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pomelo.llm.common import checkpointed


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.join(least, "a").where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges (a long, b long)`` -> ``(node, root)``: the least node of each node's component.

    Nodes without an edge are not listed, nor are roots themselves.
    """
    edges = checkpointed(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    before = None
    while True:
        edges = checkpointed(_small_star(_large_star(edges)))
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
