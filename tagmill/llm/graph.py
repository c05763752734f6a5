"""Connected components of an edge list by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.llm.common import staged


def _tidy(edges: DataFrame, left: str, right: str) -> DataFrame:
    return (edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
            .filter("u <> v").distinct())


def _is_star_forest(edges: DataFrame) -> bool:
    """Every node hangs on one centre, and no centre hangs on another."""
    several = edges.groupBy("u").agg(F.count("*").alias("n")).filter("n > 1").select("u")
    chained = edges.select(F.col("v").alias("u")).distinct().join(edges.select("u"), "u", "left_semi")
    return several.union(chained).isEmpty()


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``id, component`` of the nodes that are not the smallest of their component.

    Each round hangs every node on the smallest node it sees, first over all its
    neighbours, then over its smaller ones; minima are taken map-side first and
    the joins are plain, so a hub is split by Spark like any skewed join. Each
    round is written to the shared folder. No edges give no rows.
    """
    stars = staged(_tidy(edges, left, right), "edges")
    while not _is_star_forest(stars):
        both = stars.select("u", "v").union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        centre = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(centre, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = _tidy(large, "a", "b")
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("a"),
                                               F.col("m").alias("b"))
        stars = staged(_tidy(small, "a", "b"), "edges")
    return stars.select(F.col("u").alias("id"), F.col("v").alias("component"))
