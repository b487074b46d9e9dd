"""Connected components of a graph given as links, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.session import materialize


def _least(links: DataFrame) -> DataFrame:
    """``x``, ``y`` and the least neighbour ``m`` of ``x``; links that meet in one node are split by Spark."""
    return links.join(links.groupBy("x").agg(F.min("y").alias("m")), "x")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("y").alias("x"), F.col("x").alias("y")))
    low = F.least("x", "m")
    return _least(both).where("y > x").select(F.col("y").alias("x"), low.alias("y"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y"))
    pairs = _least(down)
    moved = pairs.where("y <> m").select(F.col("y").alias("x"), F.col("m").alias("y"))
    return moved.union(pairs.groupBy("x").agg(F.first("m").alias("y"))).where("x <> y").distinct()


def components(links: DataFrame) -> DataFrame:
    """One row per linked node: ``node`` and ``root``, the least node of its component.

    ``links`` has two columns of one orderable type, in any direction; repeats, self-links and links
    with a null end are ignored, and no links give no rows. Every round is written to the shared
    folder, so a lost executor costs at most one round. The number of rounds grows with the logarithm
    of the longest path, and no round gathers the neighbours of a node in one place.
    """
    a, b = links.columns
    current = materialize(
        links.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y").distinct(), "links")
    state = None
    while True:
        moved = materialize(_small_star(_large_star(current)), "links")
        found = moved.agg(F.count("*"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first()
        if found == state:
            return moved.select(F.col("x").alias("node"), F.col("y").alias("root"))
        current, state = moved, found
