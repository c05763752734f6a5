"""Training sets, splits and batches. Every draw is a hash of the entity, so it
does not depend on partitioning, order or reruns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.functions.constants import SEED
from tagmill.functions.hashing import hash_hex, unit_interval
from tagmill.operators import labels as label_ops
from tagmill.operators import ranking
from tagmill.sources import readers

# Families whose presence fits in one whole number.
_BITS = 62


def prepare(features: DataFrame, labels: DataFrame, unique: bool = False) -> DataFrame:
    """Attach labels to features; unlabelled entities are dropped."""
    return label_ops.attach(features, labels, unique)


def class_counts(df: DataFrame) -> DataFrame:
    """Rows per label."""
    return df.groupBy("label").agg(F.count("*").alias("n"))


def balance(df: DataFrame, ratio: float = 1.0, seed: int = SEED) -> DataFrame:
    """As many rows of class 0 as the smaller class has, and ``ratio`` times that of class 1.

    The rows with the smallest hashes of the entity are taken.
    """
    keyed = df.withColumn("__hash", hash_hex("entity", seed))
    smaller = class_counts(df).agg(F.min("n")).scalar()
    quota = F.when(F.col("label") == 0, smaller).otherwise(F.floor(smaller * F.lit(ratio)))
    marked = keyed.withColumn("__quota", quota)
    chosen = ranking.smallest_by_hash(marked, ["label"], "__hash", ["entity"], "__quota")
    return chosen.select(*df.columns)


def repeated_holdout(df: DataFrame, ratio: float = 0.8, seeds: Sequence[int] = (1, 2, 3, 4, 5)) -> DataFrame:
    """Independent random splits, one per seed: input columns plus ``seed, is_train``.

    The larger side is the training side.
    """
    spread = df.withColumn("seed", F.explode(F.array(*[F.lit(s) for s in seeds])))
    draw = F.conv(F.substring(F.md5(F.concat_ws(":", "seed", F.col("entity").cast("string"))), 1, 8), 16, 10)
    first = draw.cast("bigint") / F.lit(float(1 << 32)) < F.lit(ratio)
    return spread.withColumn("is_train", first if ratio >= 0.5 else ~first)


def folds(df: DataFrame, k: int = 5, seed: int = SEED) -> DataFrame:
    """Disjoint folds 0 to k-1."""
    return df.withColumn("fold", F.floor(unit_interval("entity", seed) * k).cast("int"))


def batches(df: DataFrame, weights: Sequence[float] = (0.2,) * 5, seed: int = SEED) -> DataFrame:
    """Split into weighted random batches numbered from 1."""
    total = float(sum(weights))
    draw, bound, number = unit_interval("entity", seed), 0.0, F.lit(len(weights))
    edges = []
    for weight in weights[:-1]:
        bound += weight / total
        edges.append(bound)
    for i in range(len(edges), 0, -1):
        number = F.when(draw < F.lit(edges[i - 1]), F.lit(i)).otherwise(number)
    return df.withColumn("batch", number)


def intersect(families: Sequence[DataFrame], labels: DataFrame | None = None) -> DataFrame:
    """Entities present in every family, and labelled if labels are given.

    Each entity carries one bit per family, combined map-side, so there is a
    single exchange however many families there are.
    """
    words = range(0, len(families), _BITS)
    marked = readers.union_all([
        f.select("entity", *[F.lit(1 << (i - w) if 0 <= i - w < _BITS else 0).cast("bigint").alias(f"seen{w}") for w in words])
        for i, f in enumerate(families)])
    seen = marked.groupBy("entity").agg(*[F.bit_or(f"seen{w}").alias(f"seen{w}") for w in words])
    common = seen
    for w in words:
        common = common.filter(F.col(f"seen{w}") == (1 << min(_BITS, len(families) - w)) - 1)
    common = common.select("entity")
    return common if labels is None else label_ops.attach(common, labels)


def common_training_sets(families: Mapping[str, DataFrame], labels: DataFrame) -> DataFrame:
    """``family, entity, label, features`` restricted to the entities common to all families."""
    common = intersect(list(families.values()), labels)
    rows = readers.union_all([f.select(F.lit(name).alias("family"), "entity", "features") for name, f in families.items()])
    return rows.join(common, "entity", "inner").select("family", "entity", "label", "features")
