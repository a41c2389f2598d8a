"""Connected components over an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverloom.sources.tables import cut_lineage


def _beside(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Edges (u, v) with the least node of u. The key of the summed side is an expression, so both sides of the join are
    exchanged as they are and a node with very many edges can be split."""
    return edges.join(least.select(F.expr("u | 0L").alias("u"), "least"), "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("least")).withColumn("least", F.least("u", "least"))
    return _beside(both, least).filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    moved = _beside(edges, least).filter("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.unionByName(least.select("u", F.col("least").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every node of the edges (a, b); the component is its smallest node.

    The number of rounds grows with the logarithm of the longest chain. Each round is checkpointed and moves no more rows
    than there are edges. Loops and repeated edges are fine; no edges give no rows. Nulls are dropped.
    """
    now = cut_lineage(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("a IS NOT NULL AND b IS NOT NULL AND u <> v").distinct())
    seen = None
    while True:
        # a star forest is what both steps leave as it is
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or mark[0] == 0:
            break
        seen = mark
        now = cut_lineage(_small_star(_large_star(now).distinct()).distinct())
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
