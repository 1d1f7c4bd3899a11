"""Feature snapshots and the model input columns."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.functions.dates import as_run_date
from patronlens.functions.numbers import number_or, require_columns
from patronlens.schema import FEATURE_COLUMNS

UNKNOWN = "unknown"


def contract_projection(df: DataFrame) -> DataFrame:
    """Exactly the contract's columns, in its order; a missing one is an error."""
    require_columns(df, FEATURE_COLUMNS, ValueError)
    return df.select(*FEATURE_COLUMNS)


def load_features(
    customer_360: DataFrame,
    run_date: str | date | datetime,
    snapshot_root: str | None = None,
    enforce_contract: bool = True,
) -> DataFrame:
    """The mart partition of one run date, optionally kept as a Parquet snapshot.

    The date filter prunes the mart's partitions.
    """
    day = as_run_date(run_date)
    features = customer_360.where(F.col("_run_date") == F.lit(day))
    if snapshot_root:
        path = f"{snapshot_root}/customer_features_{day.isoformat()}"
        features.write.mode("overwrite").parquet(path)
        features = features.sparkSession.read.schema(features.schema).parquet(path)
    return contract_projection(features) if enforce_contract else features


def average_order_value() -> Column:
    """All-time spend per order; 0 without orders. All-time on purpose: the 365-day
    ratio would give the training target away."""
    orders = number_or(F.col("total_order_count"), 0)
    spend = number_or(F.col("total_spend_usd"), 0)
    return F.when(orders > 0, spend / F.nullif(orders, F.lit(0.0))).otherwise(0.0)


def category(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(UNKNOWN))


def encoded(
    df: DataFrame, numeric: dict[str, Column], categorical: Sequence[str], keep: Sequence[Column]
) -> tuple[DataFrame, list[str]]:
    """``keep`` columns plus the vector ``features``, and the feature names in order.

    Categories are one-hot entries of a sparse vector, in value order, so their number
    costs neither columns nor expressions.
    """
    present = [c for c in categorical if c in df.columns]
    base = df.select(
        *keep,
        *[value.cast("double").alias(name) for name, value in numeric.items()],
        *[category(c).alias(f"_{c}") for c in present],
    )
    names, inputs, stages = list(numeric), list(numeric), []
    if present and not base.isEmpty():
        indexer = StringIndexer(
            inputCols=[f"_{c}" for c in present],
            outputCols=[f"_{c}_index" for c in present],
            stringOrderType="alphabetAsc",
        ).fit(base)
        names += [f"{c}_{v}" for c, values in zip(present, indexer.labelsArray, strict=True) for v in values]
        hot = [f"_{c}_hot" for c in present]
        encoder = OneHotEncoder(inputCols=indexer.getOutputCols(), outputCols=hot, dropLast=False)
        stages, inputs = [indexer, encoder], inputs + hot
    assembler = VectorAssembler(inputCols=inputs, outputCol="features")
    wide = Pipeline(stages=[*stages, assembler]).fit(base).transform(base)
    kept = [c for c in wide.columns if c not in numeric and not c.startswith("_")]
    return wide.select(*kept), names
