"""Nested session and event records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagmill.functions.arrays import unnest
from tagmill.functions.constants import EXCLUDED_APP, RECORDS_PER_ENTITY
from tagmill.functions.normalize import strip_quotes


def filter_valid(df: DataFrame, app: str = "app", activities: str = "activities",
                 excluded: str = EXCLUDED_APP) -> DataFrame:
    """Drop records without activities and records of system apps."""
    return df.filter((F.size(activities) > 0) & ~F.col(app).contains(excluded))


def flatten_messages(messages: str | Column, session: str = "session", activities: str = "activities") -> Column:
    """All activities of all messages that have a session; activities without a name are skipped."""
    messages = F.col(messages) if isinstance(messages, str) else messages
    with_session = F.filter(messages, lambda m: m[session].isNotNull())
    found = F.flatten(F.transform(with_session, lambda m: F.coalesce(m[session][activities], F.array())))
    return F.filter(found, lambda a: a["name"].isNotNull())


def explode(df: DataFrame, messages: str = "messages", keep: tuple[str, ...] = ("entity",)) -> DataFrame:
    """One row per activity: ``keep..., name, start, duration, refer``."""
    one = unnest(df, flatten_messages(messages), *keep, name="a")
    return one.select(*keep, "a.name", "a.start", "a.duration", "a.refer")


def to_records(df: DataFrame, messages: str = "messages", app: str = "app") -> DataFrame:
    """One record per message package: ``entity, app, time, activities`` without system apps and empty ones."""
    # Asked of the nested form, so that flattening is not evaluated once more for the test.
    any_named = F.exists(messages, lambda m: F.coalesce(
        F.exists(m["session"]["activities"], lambda a: a["name"].isNotNull()), F.lit(False)))
    kept = df.filter(any_named & ~F.col(app).contains(EXCLUDED_APP))
    return kept.select("entity", strip_quotes(app).alias("app"), "time", flatten_messages(messages).alias("activities"))


def cap_records(df: DataFrame, order_by: list[str], limit: int = RECORDS_PER_ENTITY) -> DataFrame:
    """First ``limit`` records per entity in a fixed order.

    The rank filter is recognised by Catalyst, which applies the limit per map
    task before the shuffle, so an entity with very many records sends only
    ``limit`` of them per task.
    """
    inside = Window.partitionBy("entity").orderBy(*order_by)
    return df.withColumn("__rank", F.row_number().over(inside)).filter(F.col("__rank") <= limit).drop("__rank")


def nest(df: DataFrame, keys: tuple[str, ...] = ("entity",), limit: int = RECORDS_PER_ENTITY) -> DataFrame:
    """``keys..., records``: the first ``limit`` records of an entity in one row, by time, app and activities.

    From ``entity, app, time, activities``. Activities of a record that agree in
    all fields stay once, at the first place; app, names and referrers lose their
    quotes. At most ``limit`` records of an entity leave a task. A null list of
    activities is empty.
    """
    once = F.array_distinct(F.coalesce("activities", F.array()))
    bare = F.transform(once, lambda a: F.struct(strip_quotes(a["name"]).alias("name"), a["start"].alias("start"),
                                                a["duration"].alias("duration"), strip_quotes(a["refer"]).alias("refer")))
    kept = cap_records(df.select(*keys, "time", strip_quotes("app").alias("app"), bare.alias("activities")),
                       ["time", "app", "activities"], limit)
    listed = F.array_sort(F.collect_list(F.struct("time", "app", "activities")))
    return kept.groupBy(*keys).agg(listed.alias("records"))


def event_ids(df: DataFrame, events: str = "events", keep: tuple[str, ...] = ("entity", "app")) -> DataFrame:
    """Distinct event ids of one record, comma-joined in order of appearance."""
    ids = F.array_distinct(F.array_compact(F.transform(events, lambda e: e["id"])))
    return df.select(*keep, F.array_join(ids, ",").alias("ids")).filter(F.col("ids") != "")
