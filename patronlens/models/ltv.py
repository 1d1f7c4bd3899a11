"""Lifetime value: gradient-boosted trees on customers with orders, cohort means for
the others. The trees are grown on counted cells of equal binned features."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.functions.dates import as_run_date
from patronlens.functions.numbers import number_or, require_columns
from patronlens.models import grid, trees as growth
from patronlens.models.features import average_order_value, category
from patronlens.models.metrics import regression_metrics
from patronlens.operators.split import with_split
from patronlens.workspace import stage

log = logging.getLogger(__name__)

# The model's settings.
ALGORITHM = "gradient_boosting_regressor"
TREES = 200
LEARNING_RATE = 0.05
MAX_DEPTH = 3
SEED = 42
MIN_ROWS_FOR_SPLIT = 5
TARGET = "total_spend_365d_usd"
CHANNEL = "acquisition_channel"
REQUIRED = (
    "customer_id",
    CHANNEL,
    "order_frequency_365d",
    "customer_tenure_days",
    TARGET,
    "total_spend_usd",
    "total_order_count",
)
CATEGORICAL = (CHANNEL, "segment_label")


@dataclass(frozen=True)
class Ltv:
    scores: DataFrame  # customer_id, ltv_score
    params: dict[str, object] = field(default_factory=dict)
    metrics: dict[str, float] = field(default_factory=dict)


def has_history() -> Column:
    return number_or(F.col("total_order_count"), 0) > 0


def target() -> Column:
    return F.greatest(number_or(F.col(TARGET), 0), F.lit(0.0))


def cohort_means(training: DataFrame) -> DataFrame:
    """Mean target per channel, at least 0. Money is summed as decimals."""
    spend = F.greatest(F.col("target").cast("decimal(14,2)"), F.lit(0).cast("decimal(14,2)"))
    return training.groupBy("channel").agg(F.avg(spend).alias("cohort_mean"))


def cold_start(customers: DataFrame, means: DataFrame) -> DataFrame:
    """Customers without orders valued at their channel's mean, else 0.

    The means are one row per channel, staged so that Spark knows their size and sends
    them to all tasks as long as they are small; many channels are joined by key.
    """
    means = stage(means, "cohort-means")
    value = F.coalesce(F.col("cohort_mean").cast("double"), F.lit(0.0))
    return (
        customers.select("customer_id", category(CHANNEL).alias("channel"))
        .join(means, "channel", "left")
        .select("customer_id", value.alias("ltv_score"))
    )


def train_and_score(
    features: DataFrame, run_date: str | date | datetime, trees: int = TREES
) -> Ltv:
    """A non-negative ``ltv_score`` per customer of ``features`` (a written table)."""
    require_columns(features, REQUIRED)
    day = as_run_date(run_date)
    if features.where(has_history()).isEmpty():
        log.warning("no customers with orders on %s", day)
        return Ltv(features.select("customer_id", F.lit(0.0).alias("ltv_score")))

    numeric = {
        "order_frequency_365d": number_or(F.col("order_frequency_365d"), 0),
        "avg_order_value": average_order_value(),
        "customer_tenure_days": number_or(F.col("customer_tenure_days"), 0),
    }
    categories = {c: category(c).alias(c) for c in CATEGORICAL if c in features.columns}
    wide = features.where(has_history()).select(
        "customer_id",
        category(CHANNEL).alias("channel"),
        target().alias("target"),
        *[value.cast("double").alias(name) for name, value in numeric.items()],
        *categories.values(),
    )
    wide = stage(wide, "ltv-history")
    history, bins = grid.binned(
        wide, "customer_id", list(numeric), list(categories), ["customer_id", "channel", "target"], "ltv-bins"
    )
    rows = history.count()
    if rows < MIN_ROWS_FOR_SPLIT:
        split = history.withColumn("is_validation", F.lit(False))
    else:
        split = stage(with_split(history, "customer_id", "channel"), "ltv-split")
    training = split.where(~F.col("is_validation"))
    known = F.when(~F.col("is_validation"), F.col("target").cast("decimal(24,4)"))
    cells = grid.counted_cells(
        split, bins.keys, {"n": F.count(known), "total": F.coalesce(F.sum(known), F.lit(0)).cast("double")}
    )
    counts = (cells.column(c).to_numpy().astype(float) for c in ("n", "total"))
    fitted = growth.boosted_cells(
        features.sparkSession, bins.matrix(cells), *counts, trees, LEARNING_RATE, MAX_DEPTH
    )
    predicted = grid.on_rows(split, bins.keys, cells, fitted).withColumn(
        "ltv_score", F.greatest("prediction", F.lit(0.0))
    )
    in_sample = rows < MIN_ROWS_FOR_SPLIT
    held_out = predicted.where(F.col("is_validation") | F.lit(in_sample))
    measured = regression_metrics(held_out, "target", "ltv_score").first()

    cold = cold_start(features.where(~has_history()), cohort_means(training))
    return Ltv(
        predicted.select("customer_id", "ltv_score").unionByName(cold),
        {
            "algorithm": ALGORITHM,
            "n_estimators": trees,
            "learning_rate": LEARNING_RATE,
            "max_depth": MAX_DEPTH,
            "feature_list": bins.names,
            "train_date_range": f"{day - timedelta(days=365)}/{day}",
            "validation": "in_sample" if in_sample else "holdout",
            "training_sample_count": rows,
        },
        {"rmse": measured.rmse, "mae": measured.mae},
    )
