"""Advertising feedback log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.functions.constants import UNKNOWN
from tagmill.functions.normalize import entity_id, has_any, key_value, part
from tagmill.operators import bags, labels


def parse_log(df: DataFrame, column: str = "value") -> DataFrame:
    """``entity, campaign, channel, feedback, matched`` of comma-separated lines; broken lines are dropped."""
    line = F.col(column)
    parsed = df.select(
        entity_id(key_value(part(line, 6, ","))).alias("entity"),
        key_value(part(line, 2, ",")).alias("campaign"),
        key_value(part(line, 3, ",")).alias("channel"),
        part(line, 4, ",").alias("feedback"),
        part(line, 7, ",").alias("matched"),
    )
    return parsed.dropna()


def campaigns_per_entity(log: DataFrame) -> DataFrame:
    """Distinct campaign codes per entity, long form."""
    return bags.union_sets(log.select("entity", F.array("campaign", "channel").alias("codes")), "codes")


def audience(log: DataFrame, wanted: list[str]) -> DataFrame:
    """Entities that ever met one of the wanted campaigns."""
    hit = log.filter(has_any(F.array("campaign", "channel"), wanted))
    return hit.select("entity").distinct()


def labelled_audience(log: DataFrame, wanted: list[str], known: DataFrame) -> DataFrame:
    """The audience with its label text, ``Unknown`` when there is none."""
    joined = audience(log, wanted).join(labels.dedupe(known), "entity", "left")
    return joined.select("entity", F.coalesce(F.col("label").cast("string"), F.lit(UNKNOWN)).alias("label"))
