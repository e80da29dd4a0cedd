"""Connected components by alternating stars, every round written out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from umbu.llm.tables import keep


def _starred(edges: DataFrame) -> DataFrame:
    """One large star and one small star over edges (u, v) with u > v."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = large.distinct()
    lowest = large.groupBy("u").agg(F.min("v").alias("m"))
    moved = large.join(lowest, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return lowest.select("u", F.col("m").alias("v")).union(moved).distinct()


def components(edges: DataFrame, purpose: str) -> DataFrame:
    """Smallest node reachable: one row (node, root) for each node but the roots.

    ``edges`` holds two whole-number columns; loops and repeats do no harm, and no
    edges give no rows. The rounds needed grow with the logarithm of the longest
    path. Stars with very many leaves are aggregated before they are shuffled.
    """
    a, b = edges.columns
    edges = edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    edges = keep(edges.distinct(), purpose)
    mark = None
    while True:
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == mark or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark, edges = now, keep(_starred(edges), purpose)
