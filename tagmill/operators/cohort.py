"""Choosing entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.functions.normalize import has_any, size_between

__all__ = ["has_any", "size_between", "restrict", "merge", "stable", "modal", "bounded_sets"]


def restrict(df: DataFrame, ids: DataFrame, key: str = "entity") -> DataFrame:
    """Keep the rows whose key is in ``ids``."""
    return df.join(ids.select(key), key, "left_semi")


def merge(first: DataFrame, second: DataFrame, key: str = "entity") -> DataFrame:
    """Inner join on the entity."""
    return first.join(second, key, "inner")


def stable(df: DataFrame, periods: int) -> DataFrame:
    """Entities seen in exactly ``periods`` distinct periods."""
    once = df.select("entity", "period").distinct()
    return (once.groupBy("entity").agg(F.count("*").alias("n"))
            .filter(F.col("n") == periods).select("entity"))


def modal(df: DataFrame) -> DataFrame:
    """Most frequent value per entity and how often it occurs; ties go to the smallest value.

    Counting by ``(entity, value)`` runs first, so a heavy entity reaches the
    second step as one row per distinct value and partial maxima.
    """
    counts = df.groupBy("entity", "value").agg(F.count("*").alias("freq"))
    best = F.min(F.struct((-F.col("freq")).alias("order"), F.col("value")))
    return (counts.groupBy("entity").agg(best.alias("best"))
            .select("entity", F.col("best.value").alias("value"), (-F.col("best.order")).alias("freq")))


def bounded_sets(df: DataFrame, arrays: list[str], below: int = 100) -> DataFrame:
    """Rows whose identifier sets are all non-empty and each smaller than ``below``.

    Applied to each period's rows before they are merged.
    """
    keep = F.lit(True)
    for name in arrays:
        keep = keep & size_between(F.array_distinct(name), 1, below)
    return df.filter(keep)
