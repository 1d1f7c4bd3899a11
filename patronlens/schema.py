"""Declared schemas, keys and value domains of every table."""

from __future__ import annotations

from pyspark.sql import types as T

# The declared columns and keys of all tables.
AUDIT_DDL = "_ingested_at timestamp, _run_date date"

RAW_DDL = {
    "customers": (
        "customer_id string, name string, email string, acquisition_channel string, "
        f"country_code string, account_created_at date, {AUDIT_DDL}"
    ),
    "orders": (
        "order_id string, customer_id string, order_status string, "
        f"total_amount_usd decimal(12,2), ordered_at timestamp, {AUDIT_DDL}"
    ),
    "order_items": (
        "order_item_id string, order_id string, product_id string, quantity int, "
        f"unit_price_usd decimal(10,2), {AUDIT_DDL}"
    ),
    "events": (
        "event_id string, session_id string, customer_id string, event_type string, "
        f"page_url string, device_type string, occurred_at timestamp, {AUDIT_DDL}"
    ),
    "campaigns": (
        "campaign_id string, platform string, campaign_name string, "
        "daily_spend_usd decimal(12,2), impressions int, clicks int, campaign_date date, "
        f"{AUDIT_DDL}"
    ),
    "tickets": (
        "ticket_id string, customer_id string, subject string, description string, "
        "status string, priority string, created_at timestamp, resolved_at timestamp, "
        f"{AUDIT_DDL}"
    ),
}

RAW_KEYS = {
    "customers": ("customer_id",),
    "orders": ("order_id",),
    "order_items": ("order_item_id",),
    "events": ("event_id",),
    "campaigns": ("campaign_id", "campaign_date"),
    "tickets": ("ticket_id",),
}

ML_SCORES_DDL = (
    "customer_id string, score_date date, model_run_id string, ltv_score decimal(12,2), "
    "churn_score decimal(5,4), churn_risk_tier string, segment_label string, "
    "anomaly_flag boolean, "
    "anomaly_detail struct<metric:string,observed:decimal(18,4),"
    "expected_range:struct<low:decimal(18,4),high:decimal(18,4)>,severity:string>, "
    "scored_at timestamp"
)

RUN_EVENT_DDL = (
    "run_id string, run_date date, job_name string, status string, event_at timestamp, "
    "rows_ingested long, duration_seconds int, notes string, rows_transformed long, "
    "qg_tests_total int, qg_tests_passed int, qg_tests_failed int, sla_breach_at timestamp"
)

DQ_FAILURE_DDL = (
    "run_date date, failure_type string, source_domain string, table_name string, "
    "checkpoint_or_test_name string, failing_column string, failing_expectation string, "
    "sample_failing_rows string, logged_at timestamp"
)

# The accepted value domains.
ACQUISITION_CHANNELS = ("organic", "paid_search", "social", "referral", "direct")
ORDER_STATUSES = ("completed", "pending", "cancelled", "refunded")
AD_PLATFORMS = ("google_ads", "meta_ads")
TICKET_STATUSES = ("open", "in_progress", "closed")
OPEN_TICKET_STATUSES = ("open", "in_progress")
TICKET_PRIORITIES = ("low", "medium", "high")
RISK_TIERS = ("Low", "Medium", "High")

# The feature contract, in order.
FEATURE_COLUMNS = (
    "customer_id",
    "recency_score",
    "frequency_score",
    "monetary_score",
    "rfm_score",
    "recency_days",
    "order_frequency_365d",
    "total_spend_365d_usd",
    "total_order_count",
    "total_spend_usd",
    "most_recent_event_date",
    "days_since_last_event",
    "days_since_last_order",
    "order_count_last_30d",
    "order_count_prior_30d",
    "order_frequency_trend",
    "active_campaign_count",
    "open_ticket_count",
    "acquisition_channel",
    "customer_tenure_days",
    "is_active",
)


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def raw_schema(table: str) -> T.StructType:
    return struct(RAW_DDL[table])
