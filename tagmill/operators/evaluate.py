"""Model quality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.operators import ranking


def auc(df: DataFrame) -> DataFrame:
    """Rank-sum area under the curve of ``score, label``, tied scores sharing their average rank.

    One row; 0.5 when a class is missing. Rows collapse to one per distinct
    score first, then ranks come from distributed running sums.
    """
    by_score = df.groupBy("score").agg(
        F.count_if(F.col("label") == 1).alias("positives"), F.count("*").alias("rows"))
    ranked = ranking.running_sums(by_score, ["score"], {"below": "rows"})
    average = F.col("below") + (F.col("rows") + 1) / 2.0
    sums = ranked.agg(F.sum(F.col("positives") * average).alias("ranks"),
                      F.sum("positives").cast("double").alias("m"),
                      F.sum(F.col("rows") - F.col("positives")).cast("double").alias("n"))
    area = F.try_divide(F.col("ranks") - F.col("m") * (F.col("m") + 1) / 2, F.col("m") * F.col("n"))
    return sums.select(F.coalesce(area, F.lit(0.5)).alias("auc"))


def accuracy(df: DataFrame) -> DataFrame:
    """Share of rows whose prediction equals the label."""
    return df.agg(F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"))
