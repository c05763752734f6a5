"""The registered queries of this package and, where SQL can say the same, their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tagmill.llm import bpe, jaccard, langid, licenses, lines, mixture, negatives, rules, search, secrets, templates, vectors, warc
from tagmill.llm.common import ready

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{folder}/{name}.parquet")


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(_table(spark, folder, "pages"))


def op2_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(_table(spark, folder, "documents"))


def op3_langid(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(_table(spark, folder, "documents"))


def op4_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(_table(spark, folder, "documents"), RANKS, PATTERN)


def op5_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.link(_table(spark, folder, "documents"))


def op6_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return mixture.mix(_table(spark, folder, "documents"))


def op7_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.judge(_table(spark, folder, "documents"))


def op8_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.link(_table(spark, folder, "embeddings"))


def op9_templates(spark: SparkSession, folder: str) -> DataFrame:
    return templates.judge(_table(spark, folder, "pages"))


def op10_lines(spark: SparkSession, folder: str) -> DataFrame:
    return lines.classify(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op11_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op12_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return negatives.mine(_table(spark, folder, "embeddings"))


def op13_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(_table(spark, folder, "documents")).drop("notices")


QUERIES = {f.__name__: f for f in (op1_warc, op2_secrets, op3_langid, op4_bpe, op5_jaccard, op6_mixture, op7_rules, op8_vectors,
                                 op9_templates, op10_lines, op11_search, op12_negatives, op13_licenses)}
SQL = {"op1_warc": warc.sql(), "op6_mixture": mixture.sql(), "op9_templates": templates.sql(), "op11_search": search.sql(),
       "op12_negatives": negatives.sql()}
