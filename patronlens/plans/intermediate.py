"""Per-order, per-customer and per-session aggregates.

Each aggregate combines on the map side before its shuffle, so a customer,
order or session with very many rows costs one partial row per map task.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.functions.dates import days_before, micros_between, whole_days_until
from patronlens.schema import OPEN_TICKET_STATUSES

MONEY = "decimal(14,2)"


def _run_date_column(run_date: date) -> Column:
    return F.lit(run_date).alias("_run_date")


def int_orders_with_items(orders: DataFrame, items: DataFrame, run_date: date) -> DataFrame:
    """Orders that have at least one item. Items are counted before the join."""
    counts = items.groupBy("order_id").agg(F.count("order_item_id").alias("item_count"))
    average = F.col("total_amount_usd") / F.nullif(F.col("item_count"), F.lit(0))
    return orders.join(counts, "order_id").select(
        "order_id",
        "customer_id",
        "order_status",
        "total_amount_usd",
        "item_count",
        average.cast("decimal(10,2)").alias("avg_item_value_usd"),
        "ordered_at",
        _run_date_column(run_date),
    )


def int_customer_orders(orders_with_items: DataFrame, run_date: date) -> DataFrame:
    """All-time and trailing-window order metrics, over orders of every status.

    The windows have no upper end: an order dated after the run date is recent.
    """
    day = F.to_date("ordered_at")
    within_365 = day >= days_before(run_date, 365)
    within_30 = day >= days_before(run_date, 30)
    from_60_to_30 = (day >= days_before(run_date, 60)) & (day < days_before(run_date, 30))
    amount = F.col("total_amount_usd")
    metrics = orders_with_items.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_order_count"),
        F.sum(amount).cast(MONEY).alias("total_spend_usd"),
        F.count_if(within_365).alias("order_frequency_365d"),
        F.coalesce(F.sum(F.when(within_365, amount)), F.lit(0)).cast(MONEY).alias(
            "total_spend_365d_usd"
        ),
        F.count_if(within_30).alias("order_count_last_30d"),
        F.count_if(from_60_to_30).alias("order_count_prior_30d"),
        F.max("ordered_at").alias("_last_order_at"),
    )
    return metrics.select(
        "customer_id",
        "total_order_count",
        "total_spend_usd",
        "order_frequency_365d",
        "total_spend_365d_usd",
        "order_count_last_30d",
        "order_count_prior_30d",
        whole_days_until(run_date, F.to_date("_last_order_at")).alias("days_since_last_order"),
        _run_date_column(run_date),
    )


def int_customer_events(events: DataFrame, run_date: date) -> DataFrame:
    latest = events.groupBy("customer_id").agg(
        F.to_date(F.max("occurred_at")).alias("most_recent_event_date")
    )
    return latest.select(
        "customer_id",
        "most_recent_event_date",
        whole_days_until(run_date, F.col("most_recent_event_date")).alias("days_since_last_event"),
        _run_date_column(run_date),
    )


def int_customer_tickets(tickets: DataFrame, run_date: date) -> DataFrame:
    is_open = F.col("status").isin(*OPEN_TICKET_STATUSES)
    return (
        tickets.groupBy("customer_id")
        .agg(F.count_if(is_open).alias("open_ticket_count"))
        .withColumn("_run_date", F.lit(run_date))
    )


def int_customers(customers: DataFrame, run_date: date) -> DataFrame:
    """Customers with their tenure; name and email only if ``customers`` has them."""
    tenure = whole_days_until(run_date, F.col("account_created_at"))
    columns = [c for c in customers.columns if c not in ("ingested_at", "_run_date")]
    return customers.select(
        *columns, tenure.alias("customer_tenure_days"), _run_date_column(run_date)
    )


def int_sessions(events: DataFrame, run_date: date) -> DataFrame:
    """Session bounds by the supplied session id alone; a session may span customers."""
    bounds = events.groupBy("session_id").agg(
        F.min("occurred_at").alias("session_start"), F.max("occurred_at").alias("session_end")
    )
    seconds = micros_between(F.col("session_start"), F.col("session_end")) / F.lit(
        1_000_000
    ).cast("decimal(7,0)")
    return bounds.select(
        "session_id",
        "session_start",
        "session_end",
        seconds.cast("decimal(18,6)").alias("session_duration_seconds"),
        _run_date_column(run_date),
    )
