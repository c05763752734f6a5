"""Places matched to entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagmill.functions.arrays import unnest
from tagmill.functions.constants import UNKNOWN
from tagmill.functions.normalize import bracket_list, fill_location
from tagmill.operators import labels as label_ops
from tagmill.operators import vocab


def match_set(*lists: str | Column) -> Column:
    """Distinct ids of several ``[a,b]`` texts."""
    return F.array_distinct(F.concat(*[F.coalesce(bracket_list(c), F.array().cast("array<string>")) for c in lists]))


def matches(df: DataFrame, *lists: str) -> DataFrame:
    """Distinct ``entity, wid`` rows; entities without any match disappear."""
    return unnest(df, match_set(*lists), "entity", name="wid").distinct()


def names_per_entity(matched: DataFrame, stores: DataFrame, known: DataFrame | None = None,
                     default: str = UNKNOWN) -> DataFrame:
    """Distinct place names per entity, long form; with ``known`` only labelled entities, plus the label."""
    named = vocab.lookup(matched, stores, "wid", "name", default).select("entity", "name").distinct()
    return named if known is None else label_ops.attach(named, known)


def enrich(observations: DataFrame, residence: DataFrame) -> DataFrame:
    """Fill missing coordinates, then attach the entity's known place (inner join)."""
    return fill_location(observations).join(residence, "entity", "inner")
