"""Bags of items per entity. The long form ``entity, item, cnt`` is canonical."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagmill.functions.arrays import unnest
from tagmill.functions.normalize import not_nullish
from tagmill.sources.readers import union_all


def _rows(df: DataFrame, items: str | Column | None) -> DataFrame:
    """``entity, item`` rows; ``items`` is an array column whose repeats inside a row count once."""
    if items is None:
        return df.select("entity", "item")
    return unnest(df, row_distinct(items), "entity")


def row_distinct(items: str | Column) -> Column:
    """Distinct non-NULL items of one row's array."""
    return F.array_distinct(F.array_compact(F.col(items) if isinstance(items, str) else items))


def count_items(df: DataFrame, items: str | Column | None = None) -> DataFrame:
    """Number of rows per entity and item."""
    return _rows(df, items).groupBy("entity", "item").agg(F.count("*").alias("cnt"))


def parse(df: DataFrame, column: str = "bag") -> DataFrame:
    """Explode ``k:v,k:v`` texts to ``entity, item, cnt``; unreadable pairs are dropped."""
    pairs = unnest(df, F.split(column, ","), "entity", name="p").select("entity", F.split("p", ":").alias("p"))
    return (pairs.select("entity", F.get("p", F.lit(0)).alias("item"),
                         F.get("p", F.lit(1)).try_cast("bigint").alias("cnt"))
            .filter((F.col("item") != "") & F.col("cnt").isNotNull()))


def merge(*bags: DataFrame) -> DataFrame:
    """Sum counted bags by entity and item."""
    return union_all(bags).groupBy("entity", "item").agg(F.sum("cnt").alias("cnt"))


def active_slots(bitmap: str | Column, binary: bool = True) -> Column:
    """Number of set bits of a plain bitmap, held as bytes or as an integer."""
    c = F.col(bitmap) if isinstance(bitmap, str) else bitmap
    return F.bitmap_count(c) if binary else F.bit_count(c)


def sum_slots(df: DataFrame, slots: str | Column = "slots") -> DataFrame:
    """Total active slots per entity and item; ``slots`` is already a number per row."""
    slots = F.col(slots) if isinstance(slots, str) else slots
    return df.groupBy("entity", "item").agg(F.sum(slots).alias("cnt"))


def distinct_items(df: DataFrame, items: str | Column | None = None) -> DataFrame:
    """Distinct items per entity, long form."""
    return _rows(df, items).distinct()


def union_sets(df: DataFrame, *arrays: str) -> DataFrame:
    """Union of array-valued sets per entity, long form ``entity, item``.

    Duplicates collapse map-side on ``(entity, item)``, so an entity with very
    many rows never meets in one task.
    """
    both = F.array_distinct(F.array_compact(F.concat(*[F.coalesce(F.col(a), F.array()) for a in arrays])))
    return unnest(df, both, "entity").distinct()


def daily_counts(df: DataFrame, day: str = "day") -> DataFrame:
    """Rows per entity, item and day."""
    return df.groupBy("entity", "item", day).agg(F.count("*").alias("cnt"))


def to_sets(df: DataFrame, name: str = "items") -> DataFrame:
    """Wide form of ``entity, item``: one sorted array per entity.

    For output edges only: one row must hold all distinct items of its entity,
    so use it where the dictionary of items is bounded.
    """
    return df.groupBy("entity").agg(F.sort_array(F.collect_set("item")).alias(name))


def to_text(df: DataFrame, name: str = "bag", sep: str = ",") -> DataFrame:
    """Wide form of a counted bag as ``k:v,k:v`` ordered by item (bounded dictionaries only)."""
    pairs = F.sort_array(F.collect_list(F.struct("item", "cnt")))
    text = F.array_join(F.transform(pairs, lambda p: F.concat_ws(":", p["item"], p["cnt"])), sep)
    return df.groupBy("entity").agg(text.alias(name))


def read_columns(df: DataFrame, entity: str | Column, item: str | Column) -> DataFrame:
    """Rename any two columns or paths to ``entity, item`` and drop null-like items."""
    entity = F.col(entity) if isinstance(entity, str) else entity
    item = F.col(item) if isinstance(item, str) else item
    return df.select(entity.alias("entity"), item.alias("item")).filter(not_nullish("item"))
