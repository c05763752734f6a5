"""Ground-truth labels: one 0/1 row per entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedupe(labels: DataFrame) -> DataFrame:
    """One row per entity; conflicting labels are combined by bitwise OR."""
    return labels.groupBy("entity").agg(F.bit_or("label").alias("label"))


def attach(df: DataFrame, labels: DataFrame, unique: bool = False) -> DataFrame:
    """Add the label and drop unlabelled entities.

    ``unique=True`` skips the deduplication when the label table is known to
    hold one row per entity.
    """
    known = labels.select("entity", "label").filter(F.col("label").isNotNull())
    return df.join(known if unique else dedupe(known), "entity", "inner")


def update(origin: DataFrame, addition: DataFrame | None) -> DataFrame:
    """Distinct union of a label set and its update; without one the origin is unchanged."""
    if addition is None:
        return origin
    return origin.unionByName(addition).distinct()


def recode(c: Column | str, old: str = "2", new: str = "0") -> Column:
    """Replace one code of a label column by another."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c == old, F.lit(new)).otherwise(c)


def drop_sentinel(df: DataFrame, column: str, sentinel: str) -> DataFrame:
    """Drop the rows whose label text says that nothing was filled in."""
    return df.filter(F.col(column) != sentinel)


def union_layouts(first: DataFrame, second: DataFrame, first_columns: dict[str, str],
                  second_columns: dict[str, str]) -> DataFrame:
    """Union all of two positional layouts, each given as ``{output: input column}``."""
    return (first.select(*[F.col(src).alias(out) for out, src in first_columns.items()])
            .unionByName(second.select(*[F.col(src).alias(out) for out, src in second_columns.items()])))


def coverage(df: DataFrame, labels: DataFrame) -> DataFrame:
    """One row: distinct entities, how many are labelled, and how many per class."""
    entities = df.select("entity").distinct()
    found = entities.join(dedupe(labels), "entity", "left")
    return found.agg(
        F.count("*").alias("entities"),
        F.count("label").alias("labelled"),
        F.count_if(F.col("label") == 1).alias("positives"),
        F.count_if(F.col("label") == 0).alias("negatives"),
    )
