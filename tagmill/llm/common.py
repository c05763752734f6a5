"""Session preparation and shared-folder tables for the operators of this package."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagmill.session import ensure_checkpoint_dir, prepare

# Arrow batches stay small even where single texts are long.
ARROW = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
         "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20)}


def ready(spark: SparkSession) -> SparkSession:
    prepare(spark)
    for key, value in ARROW.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder of the application's checkpoints."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it back: lineage ends here, columns stay prunable."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc(column: str = "doc_id") -> Column:
    """CRC-32 of the decimal text of an id; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")))


def fraction_below(column: str, salt: str, fraction: float) -> Column:
    """A repeatable choice of about ``fraction`` of the rows by a hash of ``column``."""
    cell = F.pmod(F.xxhash64(F.coalesce(F.col(column).cast("string"), F.lit("")), F.lit(salt)), F.lit(1 << 30))
    return cell < F.lit(int(fraction * (1 << 30)))
