"""Connected components of a table of links, on Spark alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame) -> DataFrame:
    """``id, component`` (the smallest id reached) for every id in ``links`` (a, b).

    Alternating large-star and small-star steps: every node sends its larger,
    then its smaller neighbours to the smallest node it knows, until nothing
    changes.  Each step is a partial aggregation and a join; links and labels
    never leave the executors.  The rounds grow with the logarithm of the length
    of a chain of links.
    """
    edges = written(links.where("a != b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        edges = written(small_star(large_star(edges)))
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    labels = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return labels.union(roots)


def large_star(edges: DataFrame) -> DataFrame:
    """Joins every larger neighbour of a node to the smallest of node and neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
    return (both.join(lowest, "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("low").alias("v")).where("u != v").distinct())


def small_star(edges: DataFrame) -> DataFrame:
    """Joins a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    lowest = down.groupBy("u").agg(F.min("v").alias("low"))
    moved = down.join(lowest, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    own = lowest.select("u", F.col("low").alias("v"))
    return moved.union(own).where("u != v").distinct()
