"""Model runs as log rows, and which version is in production as a query over them."""

from __future__ import annotations

import json
from datetime import date, datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronlens.sources.tables import TableStore

RUN_TABLE = "model_runs"
RUN_DDL = (
    "model_name string, version long, run_id string, run_date date, logged_at timestamp, "
    "params string, silhouette_score double, rmse double, mae double, auc_roc double, "
    "precision double, recall double, inertia double, importances string"
)
METRICS = ("silhouette_score", "rmse", "mae", "auc_roc", "precision", "recall", "inertia")

# Model names and the promotion threshold.
SEGMENTATION = "customer_segmentation"
LTV = "customer_ltv"
CHURN = "customer_churn"
MIN_AUC = 0.70


def model_runs(store: TableStore) -> DataFrame:
    return store.read_log(RUN_TABLE, RUN_DDL)


def log_run(
    store: TableStore,
    model_name: str,
    run_id: str,
    run_date: date,
    logged_at: datetime,
    params: dict,
    metrics: dict,
    importances: dict | None = None,
) -> int:
    """Append a run under the model's next version number."""
    known = model_runs(store).where(F.col("model_name") == model_name)
    version = known.agg(F.coalesce(F.max("version"), F.lit(0)) + 1).first()[0]
    row = (
        model_name,
        version,
        run_id,
        run_date,
        logged_at,
        json.dumps(params),
        *[metrics.get(m) for m in METRICS],
        json.dumps(importances or {}),
    )
    store.append(RUN_TABLE, store.spark.createDataFrame([row], RUN_DDL).coalesce(1))
    return version


def registered_runs(runs: DataFrame) -> DataFrame:
    """Runs that enter the registry.

    Segmentation: those with a silhouette, without which there is no model. LTV:
    those with an rmse strictly below every earlier one. Churn: those with a held-out
    AUC above the threshold. The window is per model and holds one row per run.
    """
    earlier = (
        Window.partitionBy("model_name")
        .orderBy("version")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    best_before = F.min("rmse").over(earlier)
    improves = F.col("rmse").isNotNull() & (best_before.isNull() | (F.col("rmse") < best_before))
    name = F.col("model_name")
    registered = (
        F.when(name == SEGMENTATION, F.col("silhouette_score").isNotNull())
        .when(name == LTV, improves)
        .when(name == CHURN, F.coalesce(F.col("auc_roc") > MIN_AUC, F.lit(False)))
        .otherwise(F.lit(False))
    )
    return runs.withColumn("_registered", registered).where("_registered").drop("_registered")


def production_versions(runs: DataFrame) -> DataFrame:
    """One row per model with a production version: segmentation by highest
    silhouette (ties to the first version); LTV and churn by the
    newest registered version."""
    is_segmentation = F.col("model_name") == SEGMENTATION
    preference = F.struct(
        F.when(is_segmentation, F.col("silhouette_score")).otherwise(0.0).alias("first"),
        F.when(is_segmentation, -F.col("version")).otherwise(F.col("version")).alias("second"),
    )
    return (
        registered_runs(runs)
        .groupBy("model_name")
        .agg(
            F.max_by(
                F.struct("version", "run_date", "silhouette_score", "rmse", "auc_roc"), preference
            ).alias("best"),
            F.count(F.lit(1)).alias("registered_versions"),
        )
        .select("model_name", "best.*", "registered_versions")
    )
