"""Writers. Every writer but ``overwrite_days`` and ``write_framed`` replaces what is at its path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_tsv(df: DataFrame, path: str, files: int | None = None, sep: str = "\t", order_by: Sequence[Column] = ()) -> None:
    """Delimited text lines without quoting, optionally in a chosen number of files.

    With ``order_by`` the files hold consecutive ranges of that order and are sorted inside; as many tasks sort as
    there are files (few rows leave some files out).
    """
    if order_by:
        ranges = df.repartitionByRange(files, *order_by) if files is not None else df.repartitionByRange(*order_by)
        df = ranges.sortWithinPartitions(*order_by)
    elif files is not None:
        df = df.repartition(files)
    line = F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns])
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def write_json_by_day(df: DataFrame, path: str, day: str = "day") -> None:
    """JSON lines in one folder per day, all days in one job."""
    df.write.mode("overwrite").partitionBy(day).json(path)


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Parquet, optionally in folders by column value."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_bucketed(df: DataFrame, table: str, key: str = "entity", buckets: int = 48, path: str | None = None) -> None:
    """Table hashed and sorted by a key, so later joins on that key need no exchange."""
    writer = df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def write_framed(df: DataFrame, path: str, key: str = "key", value: str = "value") -> None:
    """Hadoop sequence files of ``(Text, BytesWritable)`` in a new folder; rows without a key or value are left out."""
    whole = df.select(F.col(key).cast("string").alias("k"), F.col(value).cast("binary").alias("v")).dropna()
    whole.rdd.map(lambda r: (r[0], bytearray(r[1]))).saveAsSequenceFile(path)


def overwrite_days(df: DataFrame, path: str, day: str = "day") -> None:
    """Parquet folders per day; replaces the days that ``df`` holds and leaves all others as they are."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)
