"""Turning raw columns into items."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagmill.functions.constants import UNKNOWN_CATEGORY
from tagmill.session import broadcast_if_small


def composite(*parts: str | Column, sep: str = "|") -> Column:
    """Join the parts to one item; a NULL part prints as ``null``."""
    return F.concat_ws(sep, *[F.coalesce(F.col(p) if isinstance(p, str) else p, F.lit("null")) for p in parts])


def hour_item(millis: str | Column, place: str | Column) -> Column:
    """``hour:place`` from epoch milliseconds, hour in the session time zone."""
    millis = F.col(millis) if isinstance(millis, str) else millis
    place = F.col(place) if isinstance(place, str) else place
    return F.concat_ws(":", F.hour(F.timestamp_millis(millis)).cast("string"), place)


def day(millis: str | Column) -> Column:
    """Date of epoch milliseconds in the session time zone."""
    return F.to_date(F.timestamp_millis(F.col(millis) if isinstance(millis, str) else millis))


def resolve_category(df: DataFrame, chain: Sequence[tuple[DataFrame, str, str]], default: str = UNKNOWN_CATEGORY,
                     key: str = "item", name: str = "category") -> DataFrame:
    """Follow a chain of dictionaries ``(frame, key column, value column)``; a break gives ``default``.

    The dictionaries are joined to each other first, on their own small keys, so
    the long table is joined once, whatever the length of the chain. Its rows
    stay where they are if the counted result is small enough to broadcast.
    """
    first, first_key, first_value = chain[0]
    resolved = first.select(F.col(first_key).alias("__key"), F.col(first_value).alias("__value"))
    for frame, step_key, step_value in chain[1:]:
        step = frame.select(F.col(step_key).alias("__next"), F.col(step_value).alias("__after"))
        resolved = (resolved.join(step, F.col("__value") == F.col("__next"), "left")
                    .select("__key", F.col("__after").alias("__value")))
    resolved = broadcast_if_small(resolved)
    joined = df.join(resolved, df[key] == F.col("__key"), "left")
    return joined.select(*[df[c] for c in df.columns], F.coalesce("__value", F.lit(default)).alias(name))
