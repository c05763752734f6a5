"""Turning arrays into rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unnest(df: DataFrame, items: Column | str, *keep: str, name: str = "item") -> DataFrame:
    """``keep..., name``: one row per non-NULL element.

    A plain ``explode`` makes Catalyst add a ``size(items) > 0`` filter below it,
    which computes a derived array twice; the outer form does not.
    """
    return df.select(*keep, F.explode_outer(items).alias(name)).filter(F.col(name).isNotNull())
