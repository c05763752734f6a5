"""Resolving which identifier belongs to an entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame) -> DataFrame:
    """Newest identifier per entity from ``entity, ident, day``; equal days go to the larger identifier."""
    newest = F.max(F.struct("day", "ident"))
    return df.groupBy("entity").agg(newest.alias("newest")).select("entity", F.col("newest.ident").alias("ident"))


def newest_day(days: str | Column, fmt: str = "yyyyMMdd") -> Column:
    """Last date of an ordered array of date texts, NULL if unreadable."""
    days = F.col(days) if isinstance(days, str) else days
    return F.try_to_date(F.try_element_at(days, F.lit(-1)), fmt)


def confirm(current: DataFrame, known: DataFrame, lists: str = "idents") -> DataFrame:
    """Keep an entity only if its current identifier is in its own list of known ones."""
    return (current.join(known, "entity", "inner")
            .filter(F.array_contains(F.col(lists), F.lower("ident"))))


def confirm_pairs(current: DataFrame, known: DataFrame) -> DataFrame:
    """As ``confirm`` with the known identifiers in long form ``entity, ident``."""
    pairs = known.select("entity", F.col("ident").alias("__known"))
    return current.join(pairs, [current["entity"] == pairs["entity"], F.lower(current["ident"]) == pairs["__known"]], "left_semi")
