"""Marts: the tables that analysts and models read."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.functions.dates import days_before
from patronlens.operators.tiles import ordered_integer, with_tiles
from patronlens.schema import FEATURE_COLUMNS
from patronlens.workspace import stage

RECENCY_CAP_DAYS = 999
ACTIVITY_WINDOW_DAYS = 365
CAMPAIGN_WINDOW_DAYS = 30
MONEY = "decimal(14,2)"


def mart_customers(
    customers: DataFrame, order_metrics: DataFrame, event_metrics: DataFrame, run_date: date
) -> DataFrame:
    """Customer dimension. Active here means an order or an event within 365 days."""
    ordered = F.coalesce("order_frequency_365d", F.lit(0)) >= 1
    seen = F.col("days_since_last_event").isNotNull() & (
        F.col("days_since_last_event") <= ACTIVITY_WINDOW_DAYS
    )
    return (
        customers.drop("_run_date")
        .join(order_metrics.select("customer_id", "order_frequency_365d"), "customer_id", "left")
        .join(event_metrics.select("customer_id", "days_since_last_event"), "customer_id", "left")
        .select(
            "customer_id",
            "name",
            "email",
            "acquisition_channel",
            "country_code",
            "account_created_at",
            "customer_tenure_days",
            (ordered | seen).alias("is_active"),
            F.lit(run_date).alias("_run_date"),
        )
    )


def mart_orders(orders_with_items: DataFrame, run_date: date) -> DataFrame:
    return orders_with_items.select(
        "order_id",
        "customer_id",
        "order_status",
        "total_amount_usd",
        "item_count",
        "avg_item_value_usd",
        "ordered_at",
        F.lit(run_date).alias("_run_date"),
    )


def mart_campaigns(campaigns: DataFrame, run_date: date) -> DataFrame:
    rate = F.coalesce("click_through_rate", F.lit(0.0)).cast("decimal(8,6)")
    return campaigns.select(
        "campaign_id",
        "campaign_date",
        "platform",
        "campaign_name",
        "daily_spend_usd",
        "impressions",
        "clicks",
        rate.alias("click_through_rate"),
        F.lit(False).alias("anomaly_flag"),
        F.lit(run_date).alias("_run_date"),
    )


def mart_support_tickets(tickets: DataFrame, run_date: date) -> DataFrame:
    """Ticket facts; the cluster columns stay null until topics are joined on."""
    return tickets.select(
        "ticket_id",
        "customer_id",
        "subject",
        "status",
        "priority",
        "created_at",
        "resolved_at",
        F.col("resolution_hours").cast("decimal(8,2)").alias("resolution_hours"),
        F.lit(None).cast("int").alias("cluster_id"),
        F.lit(None).cast("string").alias("cluster_label"),
        F.lit(None).cast("decimal(5,4)").alias("cluster_confidence"),
        F.lit(run_date).alias("_run_date"),
    )


def active_campaign_count(campaigns: DataFrame, run_date: date) -> DataFrame:
    """One row: campaign days with spend in the trailing window."""
    recent = F.col("campaign_date") >= days_before(run_date, CAMPAIGN_WINDOW_DAYS)
    # The date is part of the campaign key, so this filter moves below the dedup to the scan.
    return (
        campaigns.where(recent)
        .where("daily_spend_usd > 0")
        .agg(F.count(F.lit(1)).alias("active_campaign_count"))
    )


def customer_metrics(
    customers: DataFrame,
    order_metrics: DataFrame,
    event_metrics: DataFrame,
    ticket_metrics: DataFrame,
) -> DataFrame:
    """Customers with their aggregates; absent counts and sums are zero.

    Every side holds one row per customer, so no key can skew these joins.
    """
    zero = F.lit(0)
    return (
        customers.select("customer_id", "acquisition_channel", "customer_tenure_days")
        .join(order_metrics.drop("_run_date"), "customer_id", "left")
        .join(event_metrics.drop("_run_date"), "customer_id", "left")
        .join(ticket_metrics.drop("_run_date"), "customer_id", "left")
        .select(
            "customer_id",
            "acquisition_channel",
            "customer_tenure_days",
            F.coalesce("total_order_count", zero).alias("total_order_count"),
            F.coalesce("total_spend_usd", zero).cast(MONEY).alias("total_spend_usd"),
            F.coalesce("order_frequency_365d", zero).alias("order_frequency_365d"),
            F.coalesce("total_spend_365d_usd", zero).cast(MONEY).alias("total_spend_365d_usd"),
            F.coalesce("order_count_last_30d", zero).alias("order_count_last_30d"),
            F.coalesce("order_count_prior_30d", zero).alias("order_count_prior_30d"),
            "days_since_last_order",
            "most_recent_event_date",
            "days_since_last_event",
            F.coalesce("open_ticket_count", zero).alias("open_ticket_count"),
            (F.coalesce("order_frequency_365d", zero) >= 1).alias("is_active"),
        )
    )


def with_rfm_scores(metrics: DataFrame) -> DataFrame:
    """Quintiles of recency, frequency and spend among active customers, ties by
    customer id; inactive customers score 0. ``metrics`` must be a written table.

    Recency ranks the oldest last order first, an unknown one before all others.
    """

    def active_only(name: str, **order):
        key = ordered_integer(F.col(name), metrics.schema[name].dataType, **order)
        return F.when(F.col("is_active"), key)

    orderings = {
        "recency_score": active_only("days_since_last_order", descending=True, nulls_first=True),
        "frequency_score": active_only("order_frequency_365d"),
        "monetary_score": active_only("total_spend_365d_usd"),
    }
    tiled = with_tiles(metrics, "customer_id", orderings, tiles=5)
    scores = {c: F.coalesce(F.col(c), F.lit(0)).cast("smallint") for c in orderings}
    label = F.concat(
        F.lit("R"),
        F.col("recency_score").cast("string"),
        F.lit("F"),
        F.col("frequency_score").cast("string"),
        F.lit("M"),
        F.col("monetary_score").cast("string"),
    )
    return tiled.withColumns(scores).withColumn("rfm_score", label)


def mart_customer_360(
    metrics: DataFrame, campaign_count: DataFrame, run_date: date
) -> DataFrame:
    """One feature row per customer, from ``customer_metrics`` and the one-row
    ``active_campaign_count``.

    The joined customer-grain table is written once; the quintile search then
    reads only its id, flag and three value columns. Active means an order within
    365 days; events do not count here.
    """
    metrics = stage(metrics, "customer-metrics")
    recency = F.least(
        F.coalesce("days_since_last_order", F.lit(RECENCY_CAP_DAYS)), F.lit(RECENCY_CAP_DAYS)
    )
    trend = F.col("order_count_last_30d") - F.col("order_count_prior_30d")
    return (
        with_rfm_scores(metrics)
        .withColumns(
            {
                "recency_days": recency,
                "order_frequency_trend": trend,
                "active_campaign_count": F.coalesce(campaign_count.scalar(), F.lit(0)),
            }
        )
        .select(*FEATURE_COLUMNS, F.lit(run_date).alias("_run_date"))
    )


def mart_ml_scores(ml_scores: DataFrame, run_date: date) -> DataFrame:
    """Today's partition of the model scores."""
    return ml_scores.where(F.col("score_date") == F.lit(run_date)).select(
        "customer_id",
        "score_date",
        "model_run_id",
        "ltv_score",
        "churn_score",
        "churn_risk_tier",
        "segment_label",
        F.coalesce("anomaly_flag", F.lit(False)).alias("anomaly_flag"),
        "anomaly_detail",
        "scored_at",
        F.lit(run_date).alias("_run_date"),
    )
