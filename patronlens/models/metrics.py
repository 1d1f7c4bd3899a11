"""Validation metrics as aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row: rmse, mae."""
    error = F.col(predicted).cast("double") - F.col(actual).cast("double")
    return df.agg(F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae"))


def classification_metrics(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row: auc_roc, precision, recall at 0.5; a ratio without cases is 0.

    ``score`` is the raw probability. Equal scores are counted first; the running count of
    negatives goes over at most 10,001 bins of four decimals and, inside a bin, over its
    distinct scores. ``auc_roc`` is null unless both classes occur.
    """
    positive = F.col(label) == 1
    value = F.col(score).cast("double")
    per_score = df.groupBy(value.alias("score")).agg(
        F.count_if(positive).alias("p"), F.count_if(~positive).alias("q")
    )
    per_score = per_score.withColumn("bin", F.floor(F.col("score") * 10_000))
    bins = per_score.groupBy("bin").agg(F.sum("q").alias("q"))
    earlier = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select("bin", F.coalesce(F.sum("q").over(earlier), F.lit(0)).alias("in_bins"))
    inside = Window.partitionBy("bin").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    in_bin = F.coalesce(F.sum("q").over(inside), F.lit(0))
    ranked = (
        per_score.withColumn("in_bin", in_bin)
        .join(bins, "bin")
        .withColumn("q_below", F.col("in_bins") + F.col("in_bin"))
    )
    # Ordered pairs count 2, ties 1: twice the rank statistic, in exact integers.
    twice_wins = F.col("p").cast("decimal(18,0)") * (2 * F.col("q_below") + F.col("q"))
    chosen = F.col("score") >= 0.5
    sums = ranked.agg(
        F.sum("p").cast("double").alias("pos"),
        F.sum("q").cast("double").alias("neg"),
        F.sum(twice_wins).cast("double").alias("wins"),
        F.coalesce(F.sum(F.when(chosen, F.col("p"))), F.lit(0)).cast("double").alias("tp"),
        F.coalesce(F.sum(F.when(chosen, F.col("q"))), F.lit(0)).cast("double").alias("fp"),
    )

    def ratio(top, bottom):
        return F.coalesce(top / F.nullif(bottom, F.lit(0.0)), F.lit(0.0))

    both = (F.col("pos") > 0) & (F.col("neg") > 0)
    pairs = F.nullif(2 * F.col("pos") * F.col("neg"), F.lit(0.0))
    return sums.select(
        F.when(both, F.col("wins") / pairs).alias("auc_roc"),
        ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        ratio(F.col("tp"), F.col("pos")).alias("recall"),
    )
