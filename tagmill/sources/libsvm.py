"""Sparse vectors as text: ``label idx:val ...`` and its keyed variants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagmill.functions.arrays import unnest
from tagmill.operators import vocab


def _pairs(features: Column) -> Column:
    """Distinct ``struct<idx, val>`` sorted by index from ``i:v i:v`` (any blanks between)."""
    tokens = F.filter(F.split(features, r"\s+"), lambda t: t != "")
    parsed = F.transform(tokens, lambda t: F.struct(
        F.get(F.split(t, ":"), F.lit(0)).try_cast("int").alias("idx"),
        F.get(F.split(t, ":"), F.lit(1)).try_cast("double").alias("val")))
    return F.array_sort(F.array_distinct(parsed))


def _shape(df: DataFrame, keys: dict[str, Column], features: Column) -> DataFrame:
    """0-based vectors; rows whose indices are not strictly ascending, or unreadable, are dropped."""
    rows = df.select(*[c.alias(n) for n, c in keys.items()], _pairs(features).alias("p"))
    readable = F.forall("p", lambda x: x["idx"].isNotNull() & x["val"].isNotNull() & (x["idx"] >= 1))
    unique = F.size(F.array_distinct("p.idx")) == F.size("p")
    kept = rows.filter(readable & unique).dropna(subset=list(keys))
    return kept.select(*keys, F.transform("p.idx", lambda i: i - 1).alias("idxs"), F.col("p.val").alias("vals"))


def _content(lines: DataFrame, column: str) -> DataFrame:
    text = F.trim(F.col(column))
    return lines.select(text.alias("line")).filter((F.col("line") != "") & ~F.col("line").startswith("#"))


def parse_labelled(lines: DataFrame, column: str = "value") -> DataFrame:
    """``label, idxs, vals`` from ``label i:v ...``."""
    rest = F.regexp_replace("line", r"^\S+", "")
    return _shape(_content(lines, column), {"label": F.regexp_extract("line", r"^\S+", 0).try_cast("double")}, rest)


def parse_keyed(lines: DataFrame, column: str = "value") -> DataFrame:
    """``entity, idxs, vals`` from ``entity i:v ...``."""
    rest = F.regexp_replace("line", r"^\S+", "")
    return _shape(_content(lines, column), {"entity": F.regexp_extract("line", r"^\S+", 0)}, rest)


def parse_labelled_keyed(lines: DataFrame, column: str = "value") -> DataFrame:
    """``label, entity, idxs, vals`` from ``label entity<TAB>i:v ...``."""
    head, rest = F.substring_index("line", "\t", 1), F.get(F.split("line", "\t"), F.lit(1))
    keys = {"label": F.get(F.split(head, " "), F.lit(0)).try_cast("double"), "entity": F.get(F.split(head, " "), F.lit(1))}
    return _shape(_content(lines, column), keys, F.coalesce(rest, F.lit("")))


def read(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    """``label, features`` through Spark's own reader (strict files)."""
    reader = spark.read.format("libsvm")
    return (reader.option("numFeatures", num_features) if num_features else reader).load(path)


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    return parse_keyed(spark.read.text(path))


def read_labelled_keyed(spark: SparkSession, path: str) -> DataFrame:
    return parse_labelled_keyed(spark.read.text(path))


def num_features(vectors: DataFrame) -> DataFrame:
    """One row: largest 0-based index plus one."""
    return vectors.agg((F.max(F.array_max("idxs")) + 1).alias("num_features"))


def build(rows: DataFrame, start: int = 1, weighted: bool = True) -> tuple[DataFrame, DataFrame]:
    """Learn a vocabulary and encode: ``rows(id, label, bag)`` with ``bag`` as ``f:w,f:w``.

    Gives ``(vocabulary(item, idx), entries(id, label, idx, val))`` in long form.
    """
    parsed = unnest(rows, F.split("bag", ","), "id", "label", name="pair").select(
        "id", "label", F.get(F.split("pair", ":"), F.lit(0)).alias("item"),
        F.get(F.split("pair", ":"), F.lit(1)).try_cast("double").alias("weight"))
    if weighted:
        parsed = parsed.filter(F.col("weight").isNotNull())
    vocabulary = vocab.build(parsed, start)
    value = F.col("weight") if weighted else F.lit(1.0)
    return vocabulary, parsed.join(vocabulary, "item").select("id", "label", "idx", value.alias("val"))


def to_lines(vectors: DataFrame, *keys: str, sep: str = " ", shift: int = 0) -> DataFrame:
    """``keys idx:val ...`` texts of ``idxs, vals`` vectors; whole values print without decimals."""
    def number(v: Column) -> Column:
        whole = v.cast("bigint")
        return F.when(v == whole, whole.cast("string")).otherwise(v.cast("string"))

    pairs = F.zip_with("idxs", "vals", lambda i, v: F.concat_ws(":", (i + F.lit(shift)).cast("string"), number(v)))
    head = F.concat_ws(" ", *[F.col(k).cast("string") for k in keys])
    return vectors.select(F.concat_ws(sep, head, F.array_join(pairs, " ")).alias("value"))


def write(vectors: DataFrame, path: str, *keys: str, sep: str = " ", shift: int = 0) -> None:
    to_lines(vectors, *keys, sep=sep, shift=shift).write.mode("overwrite").text(path)
