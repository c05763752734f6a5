"""Boosted trees per feature family, trained and applied with Spark ML."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagmill.functions.constants import SEED
from tagmill.operators import evaluate, trainset
from tagmill.session import checkpoint, ensure_checkpoint_dir


def vectorize(encoded: DataFrame, dim: int, keep: tuple[str, ...] = ("entity",), first: int = 1) -> DataFrame:
    """Sparse ML vectors from ``idxs, vals``; index ``first`` becomes position 0 and values stay as they are.

    An index outside ``first .. first+dim-1``, a repeated index or a missing value is an error. Rows are
    converted in Arrow batches; ``array_to_vector`` would need all ``dim`` places of each row.
    """
    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("type", pa.int8()), ("size", pa.int32()), ("indices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))])
        for batch in batches:
            vectors = []
            for idxs, vals in zip(batch.column("__idxs").to_pylist(), batch.column("__vals").to_pylist(), strict=True):
                pairs = sorted(zip(idxs or [], vals or [], strict=True))
                places = [i - first for i, _ in pairs]
                if any(not 0 <= i < dim for i in places) or len(set(places)) < len(places) or any(v is None for _, v in pairs):
                    raise ValueError(f"indices must be distinct, between {first} and {first + dim - 1}, and have values: {idxs}")
                vectors.append({"type": 0, "size": dim, "indices": places, "values": [float(v) for _, v in pairs]})
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keep], pa.array(vectors, kind)], names=[*keep, "features"])

    rows = encoded.select(*keep, F.col("idxs").alias("__idxs"), F.col("vals").alias("__vals"))
    schema = T.StructType([*[rows.schema[k] for k in keep], T.StructField("features", VectorUDT())])
    return rows.mapInArrow(sparse, schema)


def dimension(encoded: DataFrame, first: int = 1) -> int:
    """Number of places that the largest index needs."""
    largest = encoded.agg(F.max(F.array_max("idxs"))).first()[0]
    return 0 if largest is None else largest - first + 1


def train(df: DataFrame, rounds: int = 20, depth: int = 6, seed: int = SEED, step: float = 0.3) -> GBTClassificationModel:
    """Logistic boosted trees on ``label, features``."""
    ensure_checkpoint_dir(df.sparkSession)
    learner = GBTClassifier(labelCol="label", featuresCol="features", lossType="logistic", maxIter=rounds,
                            maxDepth=depth, seed=seed, stepSize=step, checkpointInterval=10, cacheNodeIds=True,
                            maxMemoryInMB=512)
    return learner.fit(df.select(F.col("label").cast("double").alias("label"), "features"))


def train_families(families: Mapping[str, DataFrame], **settings) -> dict[str, GBTClassificationModel]:
    """One model per family."""
    return {name: train(df, **settings) for name, df in families.items()}


def score(model: GBTClassificationModel, df: DataFrame, keep: tuple[str, ...] = ("entity",)) -> DataFrame:
    """Probability of class 1 as ``score``; ``keep`` may include the label."""
    probability = vector_to_array("probability")
    return model.transform(df).select(*keep, F.get(probability, F.lit(1)).alias("score"))


def save(model: GBTClassificationModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> GBTClassificationModel:
    return GBTClassificationModel.load(path)


def bundle(words: Sequence[str], model: GBTClassificationModel) -> PipelineModel:
    """Vocabulary, vector builder and trees as one stored model over ``items`` (array of text).

    ``words`` are the vocabulary in order, as many as the model has places; the first is place 0. An item
    counts once; a row without known items has an empty vector and is scored like any other.
    """
    if len(words) != model.numFeatures:
        raise ValueError(f"the model has {model.numFeatures} places, the vocabulary {len(words)}")
    vectors = CountVectorizerModel.from_vocabulary(list(words), inputCol="items", outputCol="features", binary=True)
    return PipelineModel([vectors, model])


def save_bundle(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_bundle(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def cross_validate(df: DataFrame, k: int = 5, seed: int = SEED, **settings) -> DataFrame:
    """``entity, label, fold, score``: every row of ``entity, label, features`` scored by a model that has not seen its fold.

    Folds come from a hash of the entity; the ``k`` models are trained side by side.
    """
    marked = checkpoint(trainset.folds(df, k, seed))

    def out_of_fold(fold: int) -> DataFrame:
        fitted = train(marked.filter(F.col("fold") != fold), seed=seed, **settings)
        return score(fitted, marked.filter(F.col("fold") == fold), keep=("entity", "label", "fold"))

    with ThreadPoolExecutor(k) as pool:
        parts = list(pool.map(inheritable_thread_target(df.sparkSession)(out_of_fold), range(k)))
    scored = parts[0]
    for part in parts[1:]:
        scored = scored.unionByName(part)
    return scored


def fold_auc(scored: DataFrame, k: int = 5) -> DataFrame:
    """``fold, auc`` of scores out of fold; there are ``k`` of them."""
    parts = [evaluate.auc(scored.filter(F.col("fold") == fold)).select(F.lit(fold).alias("fold"), "auc") for fold in range(k)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
