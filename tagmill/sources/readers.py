"""Readers: text, nested Parquet, JSON lines, framed binary records, date windows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagmill.functions.normalize import safe_split


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines of text files as ``value``; comma-joined paths and globs are allowed."""
    if isinstance(paths, str):
        paths = paths.split(",")
    return spark.read.text(list(paths))


def read_delimited(spark: SparkSession, paths: str | Sequence[str], fields: dict[str, tuple[int, str]],
                   sep: str = "\t") -> DataFrame:
    """Typed columns of delimited lines; unreadable lines are dropped."""
    return safe_split(read_lines(spark, paths), "value", fields, sep)


def read_entities(spark: SparkSession, path: str, columns: dict[str, str] | None = None) -> DataFrame:
    """Parquet with nested projection: ``{output: dotted path}``; only those leaves are read."""
    df = spark.read.parquet(path)
    if columns is None:
        return df
    return df.select(*[F.col(source).alias(name) for name, source in columns.items()])


def read_json(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """JSON lines with a given schema; lines that are not JSON are dropped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def existing_paths(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The paths (or globs) that match something."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    kept = []
    for path in paths:
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        found = hadoop_path.getFileSystem(conf).globStatus(hadoop_path)
        if found is not None and len(found) > 0:
            kept.append(path)
    return kept


def date_window(end: str | date, days_back: int) -> list[date]:
    """All dates from ``days_back`` days before ``end`` to ``end``, both included."""
    last = date.fromisoformat(end) if isinstance(end, str) else end
    return [last - timedelta(days=back) for back in range(days_back, -1, -1)]


def month_days(month: str) -> list[date]:
    """All dates of a calendar month given as ``yyyy-MM``."""
    first = date.fromisoformat(month + "-01")
    following = (first.replace(day=28) + timedelta(days=4)).replace(day=1)
    return [first + timedelta(days=i) for i in range((following - first).days)]


def between_days(day: str | Column, first: date, last: date) -> Column:
    """Range predicate on a date (partition) column; pushed down as a partition filter."""
    day = F.col(day) if isinstance(day, str) else day
    return day.between(F.lit(first), F.lit(last))


def read_window(spark: SparkSession, root: str, end: str | date, days_back: int, day: str = "day") -> DataFrame:
    """Rows of a day-partitioned Parquet folder inside a date window; absent days are simply empty."""
    days = date_window(end, days_back)
    return spark.read.parquet(root).filter(between_days(day, days[0], days[-1]))


def read_framed(spark: SparkSession, path: str) -> DataFrame:
    """Keys and values of Hadoop sequence files of ``(Text, BytesWritable)``: ``key string, value binary``.

    Spark has no DataFrame source for this format, so the records enter through
    the RDD reader, which splits large files at their sync marks; everything
    after that is columns.
    """
    schema = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())])
    records = spark.sparkContext.sequenceFile(path, "org.apache.hadoop.io.Text", "org.apache.hadoop.io.BytesWritable")
    return spark.createDataFrame(records, schema, verifySchema=False)


def split_framed(df: DataFrame, column: str = "value") -> DataFrame:
    """Split a binary record at its first zero byte: ``header`` (JSON text), ``ts`` and ``body`` (bytes).

    Records without a zero byte are dropped.
    """
    at = F.locate("\0", F.decode(F.col(column), "ISO-8859-1"))
    others = [c for c in df.columns if c != column]
    marked = df.withColumn("__at", at).filter(F.col("__at") > 0)
    header = F.decode(F.substring(F.col(column), F.lit(1), F.col("__at") - 1), "UTF-8")
    body = F.substring(F.col(column), F.col("__at") + 1, F.length(column))
    return marked.select(*others, header.alias("header"),
                         F.get_json_object(header, "$.ts").try_cast("bigint").alias("ts"), body.alias("body"))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union all of frames with the same columns."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
