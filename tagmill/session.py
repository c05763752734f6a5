"""Session settings and lineage cutting shared by every operator."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Settings the plans rely on. All are runtime SQL settings, so they can be
# applied to a session somebody else created.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when that costs one more exchange afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def build(app_name: str = "tagmill", master: str | None = None, **settings: str) -> SparkSession:
    """Create a session with the settings above; extra settings win."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, taking it from ``spark.checkpoint.dir``.

    Only a local master may fall back to a scratch folder: on a cluster the
    folder has to be shared, so its absence is an error.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tagmill-checkpoint-")
    context.setCheckpointDir(folder)
    return folder


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and cut its lineage there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """Divide a scan that yields fewer partitions than there are cores.

    For input of a few unsplittable files that feeds expensive row work. A scan
    that already has enough partitions, as any large input does, is returned
    unchanged and is never shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


# A frame is only broadcast on request after counting that it has at most this many rows and bytes.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20


def _width(field: T.StructField) -> Column:
    """About how many bytes a value takes in memory."""
    kind = field.dataType
    if isinstance(kind, T.StringType | T.BinaryType):
        return F.coalesce(F.octet_length(field.name), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType | T.MapType | T.StructType):
        return F.coalesce(F.octet_length(F.to_json(F.struct(F.col(field.name)))), F.lit(0)) * 2 + 16
    return F.lit(8)


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``rows`` rows and ``size`` bytes; counting stops just past that."""
    widths = [_width(f) for f in df.schema.fields]
    found = df.limit(rows + 1).agg(F.count("*"), F.coalesce(F.sum(sum(widths, F.lit(8)).cast("bigint")), F.lit(0))).first()
    return found[0] <= rows and found[1] <= size


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast if it ``is_small``."""
    return F.broadcast(df) if is_small(df, rows, size) else df
