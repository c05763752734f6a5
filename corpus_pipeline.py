"""A corpus pipeline: quality, near-duplicates, secrets, mixture, token ids.

Each stage takes (spark, docs, folder) and works on everything the stage before it
kept. All but the last return the columns of ``documents``. Empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagmill.llm import bpe, jaccard, lines, mixture, secrets
from tagmill.llm.common import ready, shared_folder, staged
from tagmill.llm.queries import PATTERN, RANKS
from tagmill.session import broadcast_if_small

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# The stages train models and draw samples, which SQL cannot express.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the line classifier does not reject."""
    ready(spark)
    return lines.accepted(docs, spark.read.parquet(f"{folder}/labels.parquet")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of similar ones: that with the smallest id.

    Rows that repeat an id are one document; the first by text stays. Rows without an id stay.
    """
    ready(spark)
    found = staged(jaccard.link(docs).select("doc_id", "component_id"), "components")
    copies = found.filter("doc_id <> component_id").select("doc_id")
    again = found.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id")
    # The texts stay where they are if the ids to leave out are counted and few.
    single = docs.join(broadcast_if_small(copies.union(again).distinct()), "doc_id", "left_anti").select(*COLUMNS)
    first = Window.partitionBy("doc_id").orderBy(*[F.col(c).asc_nulls_last() for c in COLUMNS])
    several = (docs.join(broadcast_if_small(again), "doc_id", "left_semi")
               .join(broadcast_if_small(copies.distinct()), "doc_id", "left_anti").select(*COLUMNS))
    return single.unionByName(several.withColumn("k", F.row_number().over(first)).filter("k = 1").drop("k"))


def redacted(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents with secrets replaced; ``n_chars`` follows the text."""
    ready(spark)
    out = secrets.redact(docs.select(*COLUMNS))
    size = F.when(F.col("text").isNotNull(), F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", size)


def mixed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents of the mix; those taken twice are two rows."""
    ready(spark)
    return mixture.apply(docs.select(*COLUMNS))


def tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token counts and digests of each document."""
    ready(spark)
    return bpe.digests(docs, RANKS, PATTERN)


STAGES = [("quality_lines", quality), ("ngram_jaccard", near_duplicates), ("secret_redaction", redacted),
          ("source_mixture", mixed), ("byte_bpe", tokens)]


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = ready(spark).read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = shared_folder(spark, name)
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, folder)
