"""Staging views: rename, cast, keep the latest version. No business rules.

Tie-breaks list narrow columns before wide ones, the text of a ticket last and by its hash. A
caller that does not need the wide columns passes ``wide=False``; it still sees the
same surviving values, and the scan never reads the wide columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.functions.dates import micros_between
from patronlens.operators.versions import latest_version

MICROS_PER_HOUR = 3_600_000_000


def _ingested() -> Column:
    return F.col("_ingested_at").alias("ingested_at")


def stg_customers(raw: DataFrame, wide: bool = True) -> DataFrame:
    narrow = ["_run_date", "acquisition_channel", "country_code", "account_created_at"]
    detail = ["name", "email"] if wide else []
    needed = raw.select("customer_id", "_ingested_at", *narrow, *detail)
    latest = latest_version(needed, ["customer_id"], tie_break=narrow + detail)
    return latest.select(
        "customer_id",
        *detail,
        "acquisition_channel",
        "country_code",
        F.col("account_created_at").cast("date").alias("account_created_at"),
        _ingested(),
        "_run_date",
    )


def stg_orders(raw: DataFrame) -> DataFrame:
    """The null-customer filter follows the dedup: a newest version without a
    customer hides the older versions of its order."""
    latest = latest_version(raw, ["order_id"])
    return latest.where(F.col("customer_id").isNotNull()).select(
        "order_id",
        "customer_id",
        "order_status",
        F.col("total_amount_usd").cast("decimal(12,2)").alias("total_amount_usd"),
        F.col("ordered_at").cast("timestamp").alias("ordered_at"),
        _ingested(),
        "_run_date",
    )


def stg_order_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_item_id",
        "order_id",
        "product_id",
        F.col("quantity").cast("int").alias("quantity"),
        F.col("unit_price_usd").cast("decimal(10,2)").alias("unit_price_usd"),
        _ingested(),
        "_run_date",
    )


def stg_events(raw: DataFrame, wide: bool = True) -> DataFrame:
    narrow = ["_run_date", "customer_id", "occurred_at", "session_id"]
    detail = ["event_type", "device_type", "page_url"] if wide else []
    needed = raw.select("event_id", "_ingested_at", *narrow, *detail)
    latest = latest_version(needed, ["event_id"], tie_break=narrow + detail)
    columns = ["event_id", "session_id", "customer_id"]
    if wide:
        columns += ["event_type", "page_url", "device_type"]
    return latest.select(
        *columns,
        F.col("occurred_at").cast("timestamp").alias("occurred_at"),
        _ingested(),
        "_run_date",
    )


def stg_tickets(raw: DataFrame, wide: bool = True) -> DataFrame:
    narrow = ["_run_date", "customer_id", "status", "priority", "created_at", "resolved_at"]
    detail = ["subject", "description"] if wide else []
    needed = raw.select("ticket_id", "_ingested_at", *narrow, *detail)
    latest = latest_version(
        needed, ["ticket_id"], tie_break=narrow + detail[:1], wide=detail[1:]
    )
    hours = micros_between(F.col("created_at"), F.col("resolved_at")) / F.lit(
        MICROS_PER_HOUR
    ).cast("decimal(10,0)")
    return latest.select(
        "ticket_id",
        "customer_id",
        *detail,
        "status",
        "priority",
        F.col("created_at").cast("timestamp").alias("created_at"),
        F.col("resolved_at").cast("timestamp").alias("resolved_at"),
        hours.cast("decimal(20,11)").alias("resolution_hours"),
        _ingested(),
        "_run_date",
    )


def stg_campaigns(raw: DataFrame, wide: bool = True) -> DataFrame:
    narrow = ["_run_date", "daily_spend_usd", "impressions", "clicks"]
    detail = ["platform", "campaign_name"] if wide else []
    keys = ["campaign_id", "campaign_date"]
    needed = raw.select(*keys, "_ingested_at", *narrow, *detail)
    latest = latest_version(needed, keys, tie_break=narrow + detail)
    impressions = F.col("impressions").cast("int")
    clicks = F.col("clicks").cast("int")
    rate = clicks.cast("double") / F.nullif(impressions, F.lit(0)).cast("double")
    return latest.select(
        *keys,
        *detail,
        F.col("daily_spend_usd").cast("decimal(12,2)").alias("daily_spend_usd"),
        impressions.alias("impressions"),
        clicks.alias("clicks"),
        rate.alias("click_through_rate"),
        _ingested(),
        "_run_date",
    )
