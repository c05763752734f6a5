"""Feature selection against a binary label."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagmill.functions.arrays import unnest
from tagmill.functions.constants import ENTROPY_EPSILON, MISSING_CLASS_COUNT, PROBABILITY_FLOOR
from tagmill.functions.normalize import not_nullish, strip_quotes
from tagmill.operators import labels as label_ops
from tagmill.operators import ranking
from tagmill.operators.vocab import top_by_order


def triples(df: DataFrame, labels: DataFrame, families: Mapping[str, str | Column]) -> DataFrame:
    """``family, entity, item, label`` of the labelled entities, several nested columns at once.

    ``families`` maps a family name to an array-of-text column. All families
    come out of one scan and one label join. Items repeated in a row appear once.
    """
    labelled = label_ops.attach(df, labels)
    nested = F.array(*[
        F.struct(F.lit(family).alias("family"),
                 F.array_distinct(F.transform(F.col(c) if isinstance(c, str) else c, strip_quotes)).alias("items"))
        for family, c in families.items()
    ])
    per_family = unnest(labelled, nested, "entity", "label", name="f")
    rows = unnest(per_family.select("entity", "label", "f.family", "f.items"), "items", "family", "entity", "label")
    return rows.select("family", "entity", "item", "label").filter(not_nullish("item"))


def class_counts(triples_: DataFrame, missing_class: int = MISSING_CLASS_COUNT,
                 groups: Sequence[str] = ()) -> DataFrame:
    """Rows per class; a class that never occurs counts as ``missing_class``."""
    def count_of(value: int) -> Column:
        found = F.count_if(F.col("label") == value)
        return F.when(found == 0, F.lit(missing_class)).otherwise(found)

    return triples_.groupBy(*groups).agg(count_of(1).alias("all_pos"), count_of(0).alias("all_neg"))


def item_stats(triples_: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Positives and support per item."""
    return (triples_.filter(F.col("label").isin(0, 1)).groupBy(*groups, "item")
            .agg(F.sum("label").cast("bigint").alias("pos"), F.count("*").alias("n")))


def _totals_from_stats(stats: DataFrame, missing_class: int, groups: Sequence[str]) -> DataFrame:
    """Class totals re-aggregated from the per-item counts, so the triples are scanned once."""
    def at_least(total: Column) -> Column:
        return F.when(total == 0, F.lit(missing_class)).otherwise(total)

    return stats.groupBy(*groups).agg(at_least(F.sum("pos")).alias("all_pos"),
                                      at_least(F.sum(F.col("n") - F.col("pos"))).alias("all_neg"))


def _with_totals(stats: DataFrame, missing_class: int, groups: Sequence[str]) -> DataFrame:
    totals = _totals_from_stats(stats, missing_class, groups)
    if groups:
        # One row per family: bounded by the families given, not by the data.
        return stats.join(F.broadcast(totals), list(groups))
    both = totals.select(F.struct("all_pos", "all_neg")).scalar()
    return stats.withColumn("__totals", both).select("*", "__totals.all_pos", "__totals.all_neg").drop("__totals")


def _uncertainty(a: Column, b: Column) -> Column:
    eps = F.lit(ENTROPY_EPSILON)
    return -a * F.ln(a + eps) - b * F.ln(b + eps)


def entropy(triples_: DataFrame, missing_class: int = MISSING_CLASS_COUNT, groups: Sequence[str] = ()) -> DataFrame:
    """Entropy of the label given presence of the item: ``item, pos, n, entropy``.

    An item present in every row has no complement and gives NaN.
    """
    rows = _with_totals(item_stats(triples_, groups), missing_class, groups)
    total = (F.col("all_pos") + F.col("all_neg")).cast("double")
    n, pos = F.col("n").cast("double"), F.col("pos").cast("double")
    rest, rest_pos = total - n, F.col("all_pos") - pos
    inside = F.try_divide(pos, n)
    outside = F.try_divide(rest_pos, rest)
    value = (n / total * _uncertainty(inside, 1.0 - inside)
             + rest / total * _uncertainty(outside, 1.0 - outside))
    return rows.select(*groups, "item", "pos", "n", F.coalesce(value, F.lit(float("nan"))).alias("entropy"))


def chi_entropy_gini(triples_: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Sum of absolute standardized residuals, base-2 entropy and purity per item.

    ``chi`` is not the chi-square statistic and ``gini`` is purity (sum of
    squares), as in the formulas this reproduces.
    """
    rows = _with_totals(item_stats(triples_, groups), 0, groups)
    n = F.col("n").cast("double")
    pos = F.col("pos").cast("double")
    neg = n - pos
    prior = F.col("all_pos") / (F.col("all_pos") + F.col("all_neg"))
    expect_pos, expect_neg = prior * n, (1.0 - prior) * n

    def residual(seen: Column, expected: Column) -> Column:
        return F.try_divide(F.abs(seen - expected), F.sqrt(expected))

    def bits(share: Column) -> Column:
        floored = F.greatest(share, F.lit(PROBABILITY_FLOOR))
        return -floored * F.log2(floored)

    return rows.select(
        *groups, "item",
        (residual(neg, expect_neg) + residual(pos, expect_pos)).alias("chi"),
        (bits(neg / n) + bits(pos / n)).alias("ent"),
        (F.pow(neg / n, 2) + F.pow(pos / n, 2)).alias("gini"),
    )


def rank(scored: DataFrame, method: str = "row", groups: Sequence[str] = ()) -> DataFrame:
    """Rank items by ascending entropy (rounded to 12 places): ``row`` numbers or ``dense`` ranks."""
    keyed = scored.withColumn("__key", F.round("entropy", 12))
    if method == "dense":
        return ranking.dense_index(keyed, groups, "__key").drop("__key")
    return ranking.group_index(keyed, groups, ["__key", "item"]).drop("__key")


def first_ranked(scored: DataFrame, dim: int, groups: Sequence[str] = ()) -> DataFrame:
    """The items with row rank up to ``dim``: ``item, idx`` (with ``groups``), without ranking the others.

    Each task keeps its own first ``dim`` items of a group before anything is exchanged.
    """
    keyed = scored.withColumn("__key", F.round("entropy", 12))
    if not groups:
        return top_by_order(keyed, dim, "__key", "item").select("item", F.col("idx").cast("int").alias("idx"))
    inside = Window.partitionBy(*groups).orderBy("__key", "item")
    ranked = keyed.withColumn("idx", F.row_number().over(inside)).filter(F.col("idx") <= dim)
    return ranked.select(*groups, "item", F.col("idx").cast("int").alias("idx"))
