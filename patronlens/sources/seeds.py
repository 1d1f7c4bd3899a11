"""Reference dimensions shipped as CSV.

The rows are fixed values: accepted order statuses, countries and channels.
"""

from __future__ import annotations

import csv
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEED_DIR = Path(__file__).resolve().parent.parent / "seeds"

SEED_DDL = {
    "order_statuses": "status_code string, is_revenue_positive boolean",
    "country_codes": "alpha_2 string, country_name string, region string",
    "acquisition_channels": "channel_code string, label string",
}


def seed_rows(name: str) -> list[tuple[str, ...]]:
    """The rows of a packaged seed as texts."""
    with open(SEED_DIR / f"{name}.csv", newline="") as lines:
        return [tuple(row.values()) for row in csv.DictReader(lines)]


def read_seed(spark: SparkSession, name: str, root: str | None = None) -> DataFrame:
    """A seed as a DataFrame.

    With ``root`` the CSV is read from a folder that all executors share. Without
    it the packaged file is read by the driver, because executors need not have
    this package's folder; it holds at most a few dozen rows.
    """
    ddl = SEED_DDL[name]
    if root:
        return spark.read.schema(ddl).option("header", True).csv(f"{root}/{name}.csv")
    rows = seed_rows(name)
    columns = [part.split() for part in ddl.split(", ")]
    text = spark.createDataFrame(rows, ", ".join(f"{column} string" for column, _ in columns))
    return text.select(*[F.col(column).cast(kind).alias(column) for column, kind in columns])


def with_seed_labels(
    customers: DataFrame, channels: DataFrame, countries: DataFrame
) -> DataFrame:
    """Customers with the channel label and country name and region; an unknown code
    gets ``unknown``."""
    unknown = F.lit("unknown")
    return (
        customers.join(
            channels,
            customers["acquisition_channel"] == channels["channel_code"],
            "left",
        )
        .join(countries, customers["country_code"] == countries["alpha_2"], "left")
        .select(
            *[customers[c] for c in customers.columns],
            F.coalesce("label", unknown).alias("channel_label"),
            F.coalesce("country_name", unknown).alias("country_name"),
            F.coalesce("region", unknown).alias("region"),
        )
    )


def revenue_by_status(orders: DataFrame, statuses: DataFrame) -> DataFrame:
    """Orders and value per status, with the seed's revenue flag."""
    return (
        orders.groupBy("order_status")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            F.sum("total_amount_usd").cast("decimal(18,2)").alias("total_amount_usd"),
        )
        .join(statuses, F.col("order_status") == F.col("status_code"), "left")
        .select("order_status", "is_revenue_positive", "order_count", "total_amount_usd")
    )
