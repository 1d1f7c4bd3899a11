"""Churn risk of active customers: a class-balanced random forest, grown on counted cells of equal
binned features."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.functions.dates import as_run_date
from patronlens.functions.numbers import is_true, number_or, require_columns, to_number
from patronlens.models import grid, trees as growth
from patronlens.models.features import category
from patronlens.models.metrics import classification_metrics
from patronlens.models.tiers import risk_tier, rounded_score
from patronlens.operators.split import with_split
from patronlens.workspace import stage

log = logging.getLogger(__name__)

# The model's settings.
ALGORITHM = "random_forest_classifier"
TREES = 200
MAX_DEPTH = 12
SEED = 42
MIN_ROWS_FOR_SPLIT = 10
CHURN_WINDOW_DAYS = 90
MISSING_RECENCY = 999
ACTIVITY = "is_active"
NUMERIC = (
    "days_since_last_order",
    "days_since_last_event",
    "open_ticket_count",
    "order_frequency_trend",
)
CATEGORICAL = ("segment_label",)
SCORE_DDL = "customer_id string, churn_score decimal(5,4), churn_risk_tier string"


@dataclass(frozen=True)
class Churn:
    scores: DataFrame  # customer_id, churn_score, churn_risk_tier; active customers only
    params: dict[str, object] = field(default_factory=dict)
    metrics: dict[str, float | None] = field(default_factory=dict)
    importances: dict[str, float] = field(default_factory=dict)


def churn_label() -> Column:
    """1 when neither an order nor an event lies within the last 90 days; an unknown
    recency means none does."""

    def silent(column: str) -> Column:
        days = to_number(F.col(column))
        return days.isNull() | (days >= CHURN_WINDOW_DAYS)

    return (silent("days_since_last_order") & silent("days_since_last_event")).cast("int")


def churn_features() -> dict[str, Column]:
    missing = {"days_since_last_order": MISSING_RECENCY, "days_since_last_event": MISSING_RECENCY}
    return {c: number_or(F.col(c), missing.get(c, 0)) for c in NUMERIC}


def _scored(df: DataFrame, probability: Column) -> DataFrame:
    return df.select("customer_id", rounded_score(probability).alias("churn_score")).withColumn(
        "churn_risk_tier", risk_tier(F.col("churn_score"))
    )


def _train_and_score(features: DataFrame, day: date, trees: int) -> Churn:
    active = features.where(is_true(features, ACTIVITY))
    numeric = churn_features()
    categories = {c: category(c).alias(c) for c in CATEGORICAL if c in features.columns}
    wide = active.select(
        "customer_id",
        churn_label().alias("label"),
        *[value.cast("double").alias(name) for name, value in numeric.items()],
        *categories.values(),
    )
    wide = stage(wide, "churn-active")
    table, bins = grid.binned(wide, "customer_id", list(numeric), list(categories), ["customer_id", "label"], "churn-bins")
    classes = {row.label: row["count"] for row in table.groupBy("label").count().collect()}
    rows = sum(classes.values())
    params = {
        "algorithm": ALGORITHM,
        "n_estimators": trees,
        "max_depth": MAX_DEPTH,
        "random_state": SEED,
        "feature_list": bins.names,
        "training_sample_count": rows,
        "run_date": day.isoformat(),
    }
    if not classes:
        log.warning("no active customers on %s", day)
        return Churn(features.sparkSession.createDataFrame([], SCORE_DDL), params)
    if len(classes) == 1:
        only = float(next(iter(classes)))
        log.warning("one churn class on %s: constant score %.1f", day, only)
        return Churn(_scored(table, F.lit(only)), {**params, "validation": "in_sample"})

    in_sample = rows < MIN_ROWS_FOR_SPLIT
    if in_sample:
        split = table.withColumn("is_validation", F.lit(False))
    else:
        split = stage(with_split(table, "customer_id", "label"), "churn-split")
    count = lambda label: F.count_if(~F.col("is_validation") & (F.col("label") == label))
    cells = grid.counted_cells(split, bins.keys, {"stays": count(0), "leaves": count(1)})
    stays, leaves = (cells.column(c).to_numpy() for c in ("stays", "leaves"))
    every = int(stays.sum() + leaves.sum())
    balanced = tuple(every / (2 * max(1, int(c.sum()))) for c in (stays, leaves))
    spark = features.sparkSession
    votes = growth.forest_votes(spark, bins.matrix(cells), stays, leaves, balanced, trees, MAX_DEPTH, SEED)
    votes = stage(votes, "churn-votes")
    share = F.col("votes") / F.lit(float(trees * growth.VOTE_UNIT))
    raw = votes.where("cell >= 0").select("cell", share.alias("raw_score"))
    importances = {bins.names[r.feature]: round(r.share, 6) for r in votes.where("feature >= 0").select("feature", share.alias("share")).collect()}
    predicted = grid.on_rows(split, bins.keys, cells, raw)
    predicted = predicted.withColumn("churn_score", rounded_score(F.col("raw_score")))
    held_out = predicted.where(F.col("is_validation") | F.lit(in_sample))
    measured = classification_metrics(held_out, "label", "raw_score").first().asDict()
    if in_sample:
        measured["auc_roc"] = None  # only a held-out value may lead to promotion
    return Churn(
        predicted.select(
            "customer_id", "churn_score", risk_tier(F.col("churn_score")).alias("churn_risk_tier")
        ),
        {**params, "validation": "in_sample" if in_sample else "holdout"},
        measured,
        importances,
    )


def train_and_score(
    features: DataFrame, run_date: str | date | datetime, trees: int = TREES
) -> Churn | None:
    """Scores of the active customers, or ``None`` when scoring failed, so that the
    caller keeps yesterday's. A missing column is an error of the caller."""
    require_columns(features, {"customer_id", ACTIVITY, *NUMERIC})
    day = as_run_date(run_date)
    try:
        return _train_and_score(features, day, trees)
    except Exception:
        log.exception("churn scoring failed on %s", day)
        return None
