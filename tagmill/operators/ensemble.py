"""Merging sub-model scores into tags, pseudo-labels and a stacked model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagmill.functions.constants import SAMPLE_HIGH, SAMPLE_LOW, TAG_HIGH, TAG_IDS, TAG_LOW
from tagmill.operators import labels as label_ops
from tagmill.operators import model as model_ops

# The feature list of the stacked model, shared by training and scoring.
STACK_FEATURES = ("smax", "smin")


def combine(scores: DataFrame, n_models: int, keys: Sequence[str] = ("entity",)) -> DataFrame:
    """Largest and smallest score per entity and the number of models that did not score it."""
    return scores.groupBy(*keys).agg(
        F.max("score").alias("smax"), F.min("score").alias("smin"),
        (F.lit(n_models) - F.count("score")).cast("int").alias("missing"))


def _tagged(df: DataFrame, positive: Column, negative: Column, up: Column, down: Column,
            keys: Sequence[str]) -> DataFrame:
    tag = F.when(positive, F.lit("pos")).when(negative, F.lit("neg"))
    value = F.when(positive, 100 * up).when(negative, 100 * (1 - down))
    return df.select(*keys, tag.alias("tag"), value.alias("value")).filter(F.col("tag").isNotNull())


def tag(df: DataFrame, hi: float = TAG_HIGH, lo: float = TAG_LOW, keep_label: bool = False) -> DataFrame:
    """Positive and negative audience with a value up to 100; everything between is left out.

    Batches of a large population need no loop: the rule looks at one row at a time.
    """
    keys = ("entity", "label") if keep_label else ("entity",)
    positive = (F.col("smax") >= hi) & (F.col("smin") > lo)
    return _tagged(df, positive, F.col("smin") <= lo, F.col("smax"), F.col("smin"), keys)


def tag_stack(df: DataFrame, hi: float = TAG_HIGH, lo: float = TAG_LOW) -> DataFrame:
    """Tags from one stacked score."""
    return _tagged(df, F.col("score") >= hi, F.col("score") <= lo, F.col("score"), F.col("score"), ("entity",))


def sorted_tags(tagged: DataFrame) -> DataFrame:
    """Each audience from the strongest member to the weakest."""
    return tagged.orderBy(F.desc("tag"), F.desc("value"), "entity")


def audience(tagged: DataFrame, side: str, ids: Mapping[str, str] = TAG_IDS, keys: Sequence[str] = ("entity",)) -> DataFrame:
    """Members of one tag with the id it goes by: ``keys..., tag_id, value``."""
    members = tagged.filter(F.col("tag") == side)
    return members.select(*keys, F.lit(ids[side]).alias("tag_id"), "value")


def labelled_scores(combined: DataFrame, labels: DataFrame) -> DataFrame:
    """What the stacked model learns from: ``label, entity, smax, smin, missing`` of entities with a label."""
    return label_ops.attach(combined, labels).select("label", "entity", "smax", "smin", "missing")


def pseudo_labels(df: DataFrame, hi: float = SAMPLE_HIGH, lo: float = SAMPLE_LOW) -> DataFrame:
    """Confident entities as new labels; the positive rule is tested first."""
    label = F.when(F.col("smax") >= hi, F.lit(1)).when(F.col("smin") <= lo, F.lit(0))
    return df.select("entity", label.alias("label")).filter(F.col("label").isNotNull())


def stack_vectors(combined: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Feature vectors of the stacked model."""
    assembler = VectorAssembler(inputCols=list(STACK_FEATURES), outputCol="features")
    return assembler.transform(combined).select(*keep, "features")


def train_stack(combined: DataFrame, labels: DataFrame, rounds: int = 20) -> GBTClassificationModel:
    """Shallow boosted trees over the combined scores of labelled entities."""
    labelled = label_ops.attach(combined, labels)
    return model_ops.train(stack_vectors(labelled, ["label"]), rounds=rounds, depth=2)


def score_stack(model: GBTClassificationModel, combined: DataFrame) -> DataFrame:
    """``entity, score`` of the stacked model."""
    return model_ops.score(model, stack_vectors(combined, ["entity"]))
