"""Daily metrics compared with their own trailing 30 days."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WINDOW_DAYS = 30
WARNING_Z = 2
CRITICAL_Z = 3
VALUE = "decimal(18,4)"


def daily_anomalies(metrics: DataFrame) -> DataFrame:
    """Evaluate rows (metric_name, run_date, observed_value).

    Input is one row per metric and day, so a metric's window holds as many rows
    as the metric has days. Sums are exact decimals: the result does not depend
    on the order in which tasks finish.
    """
    day = F.unix_date("run_date")
    trailing = (
        Window.partitionBy("metric_name").orderBy(F.col("day")).rangeBetween(-WINDOW_DAYS, -1)
    )
    value = F.col("observed_value")
    base = metrics.select(
        "metric_name",
        "run_date",
        F.col("observed_value").cast(VALUE).alias("observed_value"),
        day.alias("day"),
    )
    sums = base.withColumns(
        {
            "n": F.count(value).over(trailing),
            "total": F.sum(value).over(trailing).cast(VALUE),
            "squares": F.sum((value * value).cast("decimal(34,8)")).over(trailing),
        }
    )
    ready = F.col("n") >= WINDOW_DAYS
    # n * sum(x^2) - sum(x)^2 is exact; only the last division is floating point.
    squares = F.col("squares").cast("decimal(34,8)") * F.col("n").cast("decimal(3,0)")
    spread = squares - F.col("total") * F.col("total")
    count = F.col("n").cast("double")
    mean = F.col("total").cast("double") / count
    deviation = F.sqrt(spread.cast("double")) / count
    stats = sums.withColumns(
        {
            "rolling_mean_30d": F.when(ready, mean).cast(VALUE),
            "rolling_std_30d": F.when(ready, deviation).cast(VALUE),
        }
    )
    mean_d = F.col("rolling_mean_30d").cast("double")
    std_d = F.nullif(F.col("rolling_std_30d").cast("double"), F.lit(0.0))
    z = (F.col("observed_value").cast("double") - mean_d) / std_d
    widest = F.greatest(F.least(z, F.lit(9999.9999)), F.lit(-9999.9999))
    z = F.when(z.isNotNull(), widest.cast("decimal(8,4)"))
    margin = F.col("rolling_std_30d") * WARNING_Z
    scored = stats.withColumns(
        {
            "z_score": z,
            "expected_range_low": (F.col("rolling_mean_30d") - margin).cast(VALUE),
            "expected_range_high": (F.col("rolling_mean_30d") + margin).cast(VALUE),
        }
    )
    severity = (
        F.when(~ready, "baseline_pending")
        .when(F.abs("z_score") > CRITICAL_Z, "Critical")
        .when(F.abs("z_score") > WARNING_Z, "Warning")
    )
    return scored.select(
        "run_date",
        "metric_name",
        "observed_value",
        "rolling_mean_30d",
        "rolling_std_30d",
        "z_score",
        F.coalesce(F.abs("z_score") > WARNING_Z, F.lit(False)).alias("anomaly_flag"),
        severity.alias("severity"),
        "expected_range_low",
        "expected_range_high",
    )


def anomaly_detail(anomalies: DataFrame) -> DataFrame:
    """Flagged rows with their detail as a typed struct."""
    expected = F.struct(
        F.col("expected_range_low").alias("low"), F.col("expected_range_high").alias("high")
    )
    detail = F.struct(
        F.col("metric_name").alias("metric"),
        F.col("observed_value").alias("observed"),
        expected.alias("expected_range"),
        "severity",
    )
    return anomalies.where("anomaly_flag").select(
        "run_date", "metric_name", detail.alias("anomaly_detail")
    )


def daily_metrics(orders: DataFrame, events: DataFrame, tickets: DataFrame) -> DataFrame:
    """Order count and value, event count and ticket count per day."""

    def per_day(df: DataFrame, column: str, name: str, total) -> DataFrame:
        return df.groupBy(F.to_date(column).alias("run_date")).agg(
            F.lit(name).alias("metric_name"), total.cast(VALUE).alias("observed_value")
        )

    rows = F.count(F.lit(1))
    both = orders.groupBy(F.to_date("ordered_at").alias("run_date")).agg(
        rows.cast(VALUE).alias("order_count"),
        F.sum("total_amount_usd").cast(VALUE).alias("order_value_usd"),
    )
    order_metrics = both.unpivot(
        "run_date", ["order_count", "order_value_usd"], "metric_name", "observed_value"
    )
    columns = ["metric_name", "run_date", "observed_value"]
    return (
        order_metrics.select(*columns)
        .unionByName(per_day(events, "occurred_at", "event_count", rows).select(*columns))
        .unionByName(per_day(tickets, "created_at", "ticket_count", rows).select(*columns))
    )
