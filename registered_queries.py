"""The queries of the driver contract: name -> function of (spark, sample folder)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronlens.functions.dates import days_before
from patronlens.functions.numbers import is_true, number_or, to_number
from patronlens.models import (
    churn,
    insights,
    ltv,
    metrics,
    outputs,
    registry,
    scoring,
    segmentation,
    topics,
)
from patronlens.models.features import average_order_value, category, load_features
from patronlens.models.tiers import risk_tier
from patronlens.operators import anomaly
from patronlens.operators.encode import MONETARY_COLUMNS, clip, one_hot, with_log1p
from patronlens.operators.orphans import orphan_rows
from patronlens.operators.split import with_split
from patronlens.operators.upsert import replace_by_key
from patronlens.plans import maintained, marts, staging
from patronlens.plans.build import Layers
from patronlens.plans.daily import run_day
from patronlens.plans.ingest import (
    DOMAIN_OF,
    checked_batches,
    live_tables,
    load_all,
    write_all,
    write_indexes,
    write_upserted,
)
from patronlens.plans.pipeline import build_layers
from patronlens.quality import assertions
from patronlens.quality.checks import check_tables, columns_needed
from patronlens.quality.constraints import accepted, all_rejections
from patronlens.quality.gate import failure_rows
from patronlens.quality.stored import StoredChecks
from patronlens.quality.suites import model_suites, raw_suites, staging_suites
from patronlens.runlog import run_states
from patronlens.schema import ML_SCORES_DDL, RAW_KEYS, RUN_EVENT_DDL, struct
from patronlens.sources import sample_tables, seeds
from patronlens.sources.raw import with_known_parent
from patronlens.sources.sample_tables import LOADED_AT, RUN_DATE, raw_tables
from patronlens.sources.seeds import read_seed, with_seed_labels
from patronlens.sources.tables import TableStore, ddl_of
from patronlens.workspace import scratch_path, stage

SCORED_AT = LOADED_AT + timedelta(hours=4)

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    """Register ``run`` under its name; timestamps leave as zone-free wall-clock values."""

    def with_plain_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = run(spark, sf_dir)
        stamped = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
        return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamped})

    _QUERIES[run.__name__] = with_plain_timestamps
    return run


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def layers(spark: SparkSession, sf_dir: str, faults: bool = False) -> Layers:
    return Layers(raw_tables(spark, sf_dir, faults), RUN_DATE)


# Staging, intermediate and mart tables.


@query
def stg_customers_dedup(spark, sf_dir):
    return layers(spark, sf_dir).stg_customers


@query
def stg_orders_dedup(spark, sf_dir):
    return layers(spark, sf_dir).stg_orders


@query
def stg_order_items(spark, sf_dir):
    return layers(spark, sf_dir).stg_order_items


@query
def stg_events_dedup(spark, sf_dir):
    return layers(spark, sf_dir).stg_events


@query
def stg_tickets_dedup(spark, sf_dir):
    return layers(spark, sf_dir).stg_tickets


@query
def stg_campaigns_dedup(spark, sf_dir):
    return layers(spark, sf_dir).stg_campaigns


@query
def orders_with_items(spark, sf_dir):
    return layers(spark, sf_dir).int_orders_with_items


@query
def customer_orders_agg(spark, sf_dir):
    return layers(spark, sf_dir).int_customer_orders


@query
def customer_events_agg(spark, sf_dir):
    return layers(spark, sf_dir).int_customer_events


@query
def customer_tickets_agg(spark, sf_dir):
    return layers(spark, sf_dir).int_customer_tickets


@query
def customer_tenure(spark, sf_dir):
    return layers(spark, sf_dir).int_customers


@query
def sessions_duration(spark, sf_dir):
    return layers(spark, sf_dir).int_sessions


@query
def mart_customers(spark, sf_dir):
    return layers(spark, sf_dir).mart_customers


@query
def mart_orders(spark, sf_dir):
    return layers(spark, sf_dir).mart_orders


@query
def mart_campaigns(spark, sf_dir):
    return layers(spark, sf_dir).mart_campaigns


@query
def mart_support_tickets(spark, sf_dir):
    return layers(spark, sf_dir).mart_support_tickets


@query
def active_campaign_count(spark, sf_dir):
    return layers(spark, sf_dir).active_campaign_count


@query
def customer_360(spark, sf_dir):
    return layers(spark, sf_dir).mart_customer_360


@query
def rfm_quintiles(spark, sf_dir):
    """The three tiles on their own, from the customer metrics."""
    joined = layers(spark, sf_dir).customer_metrics
    scored = marts.with_rfm_scores(stage(joined, "customer-metrics"))
    return scored.select(
        "customer_id", "recency_score", "frequency_score", "monetary_score", "rfm_score"
    )


@query
def seed_enrichment(spark, sf_dir):
    customers = layers(spark, sf_dir).stg_customers.select(
        "customer_id", "acquisition_channel", "country_code"
    )
    return with_seed_labels(
        customers, read_seed(spark, "acquisition_channels"), read_seed(spark, "country_codes")
    )


@query
def revenue_by_status(spark, sf_dir):
    orders = layers(spark, sf_dir).stg_orders
    return seeds.revenue_by_status(orders, read_seed(spark, "order_statuses"))


# Writes: upsert, replace, publish.


@query
def upsert_latest(spark, sf_dir):
    """Update one channel's customers and insert another's."""
    customers = sample_tables.customers(spark, sf_dir)
    channel = F.col("acquisition_channel")
    existing = customers.where(channel != "direct")
    batch = customers.where(channel.isin("direct", "paid_search")).withColumns(
        {
            "name": F.concat("name", F.lit("-new")),
            "_ingested_at": F.col("_ingested_at") + F.expr("interval 2 days"),
        }
    )
    store = TableStore(spark, scratch_path(spark, "upsert"))
    for rows in (existing, batch):
        store.publish(write_upserted(store, "customers", rows)[0])
    return store.read("customers")


@query
def incremental_replace_by_key(spark, sf_dir):
    """Yesterday's orders, with the last year's orders delivered again today."""
    orders = stage(layers(spark, sf_dir).mart_orders, "mart-orders")
    yesterday = orders.withColumns(
        {"order_status": F.lit("pending"), "_run_date": F.date_sub("_run_date", 1)}
    )
    today = orders.where(F.to_date("ordered_at") >= days_before(RUN_DATE, 365))
    store = TableStore(spark, scratch_path(spark, "replace"))
    replace_orders = partial(replace_by_key, keys=["order_id"])
    for rows in (yesterday, today):
        store.publish(store.merge_keyed("mart_orders", rows, ["order_id"], replace_orders)[0])
    return store.read("mart_orders")


@query
def incremental_replace_partition(spark, sf_dir):
    """Two run dates written as partitions, the second one twice."""
    store = TableStore(spark, scratch_path(spark, "partitions"))
    raw = raw_tables(spark, sf_dir)
    table = "mart_daily_order_metrics"
    for run_date in (RUN_DATE - timedelta(days=1), RUN_DATE, RUN_DATE):
        daily = Layers(raw, run_date).int_customer_orders
        store.write_partition(table, daily, "_run_date")
    return store.read_partitioned(table, ddl_of(daily.schema))


@query
def maintained_orders(spark, sf_dir):
    """Order metrics of ten run dates, each carried on from the one before. A date brings the orders of
    its day; on the sixth, cancelled orders of the forty days before are withdrawn."""
    orders = stage(layers(spark, sf_dir).int_orders_with_items, "maintained-source")
    day = F.to_date("ordered_at")
    store = TableStore(spark, scratch_path(spark, "maintained"))
    found = []
    for age in range(9, -1, -1):
        run_date = RUN_DATE - timedelta(days=age)
        fresh = orders.where(day == F.lit(run_date) if found else day <= F.lit(run_date))
        recent = day.between(F.lit(run_date - timedelta(days=40)), F.lit(run_date - timedelta(days=1)))
        gone = orders.where(recent & (F.col("order_status") == "cancelled")) if age == 4 else None
        found.append(maintained.advance_orders(store, run_date, fresh, gone))
    return reduce(DataFrame.unionByName, found)


@query
def maintained_others(spark, sf_dir):
    """Open tickets per customer, and sessions, kept over three batches: older tickets, the others, and
    the pending ones again as closed; events by their day."""
    built = layers(spark, sf_dir)
    tickets = stage(built.stg_tickets.select("ticket_id", "customer_id", "status", "priority"), "tickets")
    events = stage(staging.stg_events(built.raw.events, wide=False), "events")
    store = TableStore(spark, scratch_path(spark, "maintained-others"))
    waiting = tickets.where("status = 'in_progress'")
    closed = waiting.withColumn("status", F.lit("closed"))
    batches = [(tickets.where("priority = 'high'"), None), (tickets.where("priority <> 'high'"), None), (closed, waiting)]
    for number, (fresh, replaced) in enumerate(batches):
        parts = maintained.advance_tickets(store, fresh, replaced)
        today = events.where(F.day("occurred_at") % 3 == number)
        store.publish(parts | maintained.advance_events(store, today))
    open_ = store.read("state_customer_tickets").select(F.col("customer_id").alias("key"), F.col("open_ticket_count").alias("value"))
    seconds = F.unix_timestamp("session_end") - F.unix_timestamp("session_start")
    sessions = store.read("state_sessions").select(F.col("session_id").alias("key"), seconds.alias("value"))
    latest = store.read("state_customer_events").select("customer_id", F.unix_timestamp("last_event_at"))
    parts = [df.select(F.lit(name).alias("name"), "*") for name, df in (("tickets", open_), ("sessions", sessions), ("events", latest.toDF("key", "value")))]
    return reduce(DataFrame.unionByName, parts)


@query
def load_summary(spark, sf_dir):
    """All raw tables loaded twice as a whole; rows and a checksum per published column."""
    raw = raw_tables(spark, sf_dir)
    store = TableStore(spark, scratch_path(spark, "load"))
    load_all(store, raw, RUN_DATE)
    load_all(store, raw, RUN_DATE)
    return reduce(DataFrame.unionByName, [checksums(name, store.read(name)) for name, _ in raw.items()])


def checksums(table: str, df: DataFrame) -> DataFrame:
    """``table_name, column_name, row_count, checksum``: the sum of a hash of each value, which
    does not depend on the order of the rows."""

    def hashed(column: str):
        digest = F.md5(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))
        return F.conv(F.substring(digest, 1, 8), 16, 10).cast("decimal(20,0)")

    sums = [
        F.struct(F.lit(c).alias("column_name"), F.sum(hashed(c)).cast("decimal(38,0)").alias("checksum"))
        for c in df.columns
    ]
    found = df.agg(F.count(F.lit(1)).alias("row_count"), F.array(*sums).alias("sums"))
    return found.select(F.lit(table).alias("table_name"), F.inline("sums"), "row_count")


@query
def pipeline_tables(spark, sf_dir):
    """One pipeline run; rows and run date per stored table."""
    tables = build_layers(
        TableStore(spark, scratch_path(spark, "pipeline")), raw_tables(spark, sf_dir), RUN_DATE
    )
    counts = [
        df.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.max("_run_date").alias("run_date"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def known_parent_orders(spark, sf_dir):
    """Raw orders whose customer exists."""
    raw = raw_tables(spark, sf_dir, faults=True)
    known = with_known_parent(raw.orders, "order_id", "customer_id", raw.customers)
    return known.select("order_id", "customer_id", "total_amount_usd")


@query
def run_log_current(spark, sf_dir):
    """Run states; each session of the events table plays a run."""
    status = (
        F.when(F.col("event_type") == "purchase", "success")
        .when(F.col("event_type") == "error", "failed")
        .otherwise("running")
    )
    session = layers(spark, sf_dir).stg_events
    done = status != "running"
    events = session.select(
        F.col("session_id").alias("run_id"),
        F.to_date("occurred_at").alias("run_date"),
        F.lit("session").alias("job_name"),
        status.alias("status"),
        F.col("occurred_at").alias("event_at"),
        F.when(done, F.col("event_id").cast("long")).alias("rows_ingested"),
        F.when(done, F.hour("occurred_at")).alias("duration_seconds"),
        F.lit(None).cast("string").alias("notes"),
        F.when(done, F.minute("occurred_at").cast("long")).alias("rows_transformed"),
        F.when(done, F.lit(30)).alias("qg_tests_total"),
        F.when(status == "success", F.lit(30)).when(status == "failed", F.lit(29)).alias("qg_tests_passed"),
        F.when(status == "success", F.lit(0)).when(status == "failed", F.lit(1)).alias("qg_tests_failed"),
        F.when(status == "failed", F.col("occurred_at")).alias("sla_breach_at"),
    )
    return run_states(events)


@query
def daily_job(spark, sf_dir):
    """The daily job with the real models: rows and dates of what it stores, and what the run log says
    of the jobs."""
    store = TableStore(spark, scratch_path(spark, "daily"))
    run_day(store, raw_tables(spark, sf_dir), RUN_DATE, SCORED_AT)

    def counted(name: str, df: DataFrame, day: str, what: str = "true") -> DataFrame:
        return df.where(what).groupBy(F.col(day).alias("run_date")).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("name"), "run_date", "row_count"
        )

    scores = store.read_partitioned(scoring.SCORE_TABLE, ML_SCORES_DDL)
    jobs = run_states(store.read_log("run_events", RUN_EVENT_DDL)).where("status = 'success'")
    transformed = F.col("rows_transformed").isNotNull()
    parts = [
        counted("mart_customer_360", store.read("mart_customer_360"), "_run_date"),
        counted("ml_scores", scores, "score_date", "segment_label is not null and ltv_score >= 0"),
        counted("mart_ml_scores", store.read(scoring.MART_TABLE), "_run_date"),
        counted("tickets with a topic", store.read("mart_support_tickets"), "_run_date", "cluster_label <> ''"),
        counted("daily_insights", store.read_partitioned(outputs.INSIGHT_TABLE, outputs.INSIGHT_DDL), "run_date"),
        jobs.where("job_name = 'load_all'").select(
            F.lit("rows loaded").alias("name"), "run_date", F.col("rows_ingested").alias("row_count")
        ),
        jobs.where("job_name = 'load_all'").select(
            F.lit("checks failed").alias("name"), "run_date", F.col("qg_tests_failed").cast("long").alias("row_count")
        ),
        counted("jobs that wrote", jobs.where(transformed), "run_date"),
    ]
    return reduce(DataFrame.unionByName, parts)


# Data quality, on tables with injected bad rows.


@query
def expectation_report(spark, sf_dir):
    raw = dict(raw_tables(spark, sf_dir, faults=True).items())
    return check_tables(raw, raw_suites(), RUN_DATE)


@query
def load_rejects(spark, sf_dir):
    """What the loader keeps out of the faulty sample, and then out of a second batch that brings some
    customers again, under their own id and under another one with the same email."""
    store = TableStore(spark, scratch_path(spark, "rejects"))
    first = checked_batches(store, dict(raw_tables(spark, sf_dir, faults=True).items()))
    good = {"customers": accepted(first["customers"])}
    store.publish(write_all(store, good)[0] | write_indexes(store, good))
    again = sample_tables.customers(spark, sf_dir, faults=True).where("acquisition_channel = 'direct'")
    twins = again.withColumn("customer_id", F.concat("customer_id", F.lit("-twin")))
    fresh = again.withColumns({c: F.concat(F.lit("new-"), c) for c in ("customer_id", "email")})
    fresh = fresh.where("email <> 'new-shared@example.com'")
    batch = again.unionByName(twins).unionByName(fresh)
    second = checked_batches(store, {"customers": batch})
    found = [
        all_rejections(flagged, DOMAIN_OF, RUN_DATE, SCORED_AT).withColumn("batch", F.lit(number))
        for number, flagged in ((1, first), (2, second))
    ]
    names = ("batch", "table_name", "failing_column", "failing_expectation", "sample_failing_rows")
    return found[0].unionByName(found[1]).select(*names)


@query
def maintained_checks(spark, sf_dir):
    """The expectation report and the orphans per relation after three loads of the faulty sample, each
    carried on from the files before. Parents come last, so references have orphans at first."""
    raw = dict(raw_tables(spark, sf_dir, faults=True).items())
    store = TableStore(spark, scratch_path(spark, "maintained-checks"))
    loads = [{"order_items", "events"}, {"orders", "tickets", "campaigns"}, {"customers"}]
    for tables in loads:
        batches = {t: raw[t] for t in raw if t in tables}
        parts, loaded = write_all(store, batches)
        scans = {t: loaded[t] if t in loaded else store.read_if_exists(t) for t in raw}
        empty = {t: raw[t].limit(0) for t, df in scans.items() if df is None}
        checks = StoredChecks(store, live_tables(store, parts, scans | empty))
        orphans = checks.orphans(assertions.RAW_REFERENCES)
        report = checks.report(raw_suites(), RUN_DATE, RAW_KEYS)
        store.publish(parts | checks.written)
    names = ("table_name", "check_name", "column_name", "element_count", "unexpected_count", "sample_failing_rows")
    relations = orphans.select(
        F.substring_index("relation", ".", 1).alias("table_name"),
        F.lit("reference").alias("check_name"),
        F.substring_index("relation", ".", -1).alias("column_name"),
        F.col("child_count").alias("element_count"),
        F.col("orphan_count").alias("unexpected_count"),
        F.lit(None).cast("string").alias("sample_failing_rows"),
    )
    return report.select(*names).unionByName(relations)


@query
def dq_failures(spark, sf_dir):
    """Failed checks with keys of failing rows, found in the same scan."""
    raw = dict(raw_tables(spark, sf_dir, faults=True).items())
    report = check_tables(raw, raw_suites(), RUN_DATE, RAW_KEYS)
    return failure_rows(report, RUN_DATE, "raw", "raw_suites", SCORED_AT)


def stored_models(spark, sf_dir) -> dict[str, DataFrame]:
    """All models of the faulty sample; intermediate and mart tables as stored tables."""
    raw = raw_tables(spark, sf_dir, faults=True)
    lazy = Layers(raw, RUN_DATE)
    tables = build_layers(TableStore(spark, scratch_path(spark, "models")), raw, RUN_DATE)
    scores = sample_scores(tables["mart_customer_360"], RUN_DATE)
    tables["mart_ml_scores"] = marts.mart_ml_scores(scores, RUN_DATE)
    for name in staging_suites():
        # Only the checked columns, written once: several checks read them.
        checked = getattr(lazy, name).select(*columns_needed(name, model_suites()))
        tables[name] = stage(checked, name)
    return tables


@query
def model_check_report(spark, sf_dir):
    return check_tables(stored_models(spark, sf_dir), model_suites(), RUN_DATE)


@query
def orphan_fk_report(spark, sf_dir):
    return assertions.raw_orphans(raw_tables(spark, sf_dir, faults=True))


def _orphans(child: DataFrame, child_id: str, customers: DataFrame) -> DataFrame:
    rows = child.select(child_id, "customer_id")
    return orphan_rows(rows, F.col(child_id), "customer_id", customers, "customer_id")


@query
def orphan_orders(spark, sf_dir):
    built = layers(spark, sf_dir, faults=True)
    return _orphans(built.stg_orders, "order_id", built.stg_customers)


@query
def orphan_events(spark, sf_dir):
    built = layers(spark, sf_dir, faults=True)
    return _orphans(built.stg_events, "event_id", built.stg_customers)


@query
def orphan_tickets(spark, sf_dir):
    built = layers(spark, sf_dir, faults=True)
    return _orphans(built.stg_tickets, "ticket_id", built.stg_customers)


@query
def orphan_order_items(spark, sf_dir):
    built = layers(spark, sf_dir, faults=True)
    items = built.stg_order_items.select("order_item_id", "order_id")
    return orphan_rows(items, F.col("order_item_id"), "order_id", built.stg_orders, "order_id")


@query
def campaign_click_violations(spark, sf_dir):
    return assertions.click_violations(layers(spark, sf_dir, faults=True).mart_campaigns)


@query
def rfm_bounds_violations(spark, sf_dir):
    """The feature table with scores pushed up by one and the recency cap lifted."""
    features = layers(spark, sf_dir).mart_customer_360
    pushed = {
        "recency_score": (F.col("recency_score") + 1).cast("smallint"),
        "recency_days": F.col("days_since_last_order"),
        "rfm_score": F.when(F.col("is_active"), F.col("rfm_score")).otherwise("R0F0M1"),
    }
    return assertions.rfm_violations(features.withColumns(pushed))


def faulty_scores(customer_360: DataFrame) -> DataFrame:
    """Sample scores with negative values and tiers that do not fit."""
    channel = F.col("acquisition_channel")
    ltv = F.when(channel == "social", -F.col("ltv_score")).otherwise(F.col("ltv_score"))
    tier = F.when(channel == "direct", "High").otherwise(F.col("churn_risk_tier"))
    return (
        sample_scores(customer_360, RUN_DATE, keep="acquisition_channel")
        .withColumns({"ltv_score": ltv, "churn_risk_tier": tier})
        .drop("acquisition_channel")
    )


@query
def score_bounds_violations(spark, sf_dir):
    scores = faulty_scores(layers(spark, sf_dir).mart_customer_360)
    return assertions.score_violations(marts.mart_ml_scores(scores, RUN_DATE))


@query
def negative_money_violations(spark, sf_dir):
    built = layers(spark, sf_dir, faults=True)
    features = stage(built.mart_customer_360, "customer-360")
    scores = marts.mart_ml_scores(faulty_scores(features), RUN_DATE)
    return assertions.negative_money(built.mart_orders, built.mart_campaigns, features, scores)


@query
def volume_drift(spark, sf_dir):
    """Today's feature rows against an earlier run without one channel's customers."""
    today = layers(spark, sf_dir).mart_customer_360
    earlier = today.where("acquisition_channel <> 'direct'").withColumn(
        "_run_date", F.date_sub("_run_date", 1)
    )
    return assertions.volume_drift(today.unionByName(earlier), RUN_DATE)


@query
def source_freshness(spark, sf_dir):
    """Freshness of the raw tables two and a half days after the base load."""
    raw = dict(raw_tables(spark, sf_dir).items())
    return assertions.freshness(raw, LOADED_AT + timedelta(hours=48, minutes=30))


# Features and model steps.


def features(spark, sf_dir) -> DataFrame:
    """The feature contract of the run date, as a written table."""
    return stage(load_features(layers(spark, sf_dir).mart_customer_360, RUN_DATE), "features")


def sample_scores(customer_360: DataFrame, score_date: date, keep: str = "customer_id"):
    """Score rows by a plain rule, where a query needs scores but no model: spend, and
    the share of the recency cap that has passed."""
    churn_score = (F.col("recency_days").cast("decimal(18,10)") / 999).cast("decimal(5,4)")
    label = F.when(F.col("is_active"), F.col("rfm_score")).otherwise("Inactive")
    detail = struct(ML_SCORES_DDL)["anomaly_detail"].dataType
    return customer_360.select(
        *{"customer_id": 0, keep: 0},
        F.lit(score_date).alias("score_date"),
        F.lit("sample").alias("model_run_id"),
        F.col("total_spend_365d_usd").cast("decimal(12,2)").alias("ltv_score"),
        churn_score.alias("churn_score"),
        risk_tier(churn_score).alias("churn_risk_tier"),
        label.alias("segment_label"),
        F.lit(None).cast("boolean").alias("anomaly_flag"),
        F.lit(None).cast(detail).alias("anomaly_detail"),
        F.lit(SCORED_AT).cast("timestamp").alias("scored_at"),
    )


@query
def feature_snapshot(spark, sf_dir):
    mart = layers(spark, sf_dir).mart_customer_360
    return load_features(mart, RUN_DATE.isoformat(), scratch_path(spark, "snapshots"))


@query
def features_log1p(spark, sf_dir):
    logged = with_log1p(features(spark, sf_dir))
    return logged.select(
        "customer_id",
        *[F.col(f"{c}_log1p").cast("decimal(12,6)").alias(f"{c}_log1p") for c in MONETARY_COLUMNS],
    )


@query
def features_onehot(spark, sf_dir):
    chosen = features(spark, sf_dir).select("customer_id", "acquisition_channel", "is_active")
    return one_hot(chosen)


@query
def features_clip(spark, sf_dir):
    chosen = features(spark, sf_dir).select("customer_id", "days_since_last_order")
    return clip(chosen, "days_since_last_order", 30, 999)


@query
def avg_order_value(spark, sf_dir):
    chosen = features(spark, sf_dir)
    return chosen.select("customer_id", average_order_value().alias("avg_order_value"))


@query
def safe_coercion(spark, sf_dir):
    """Numbers and flags read from loosely typed columns."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    kind = F.col("event_type")
    text = (
        F.when(kind == "purchase", " Yes ")
        .when(kind == "click", "TRUE")
        .when(kind == "view", "0")
        .when(kind == "signup", "no")
    )
    loose = events.select(
        "event_id",
        F.get_json_object("props", "$.k").alias("k"),
        "event_type",
        text.alias("flag_text"),
        (F.col("value") - 5).alias("flag_number"),
    )
    return loose.select(
        "event_id",
        to_number(F.col("k")).alias("k_number"),
        number_or(F.col("event_type"), 0).alias("type_number"),
        is_true(loose, "flag_text").alias("flag_from_text"),
        is_true(loose, "flag_number").alias("flag_from_number"),
    )


@query
def churn_label(spark, sf_dir):
    chosen = features(spark, sf_dir)
    return chosen.where(is_true(chosen, "is_active")).select(
        "customer_id", churn.churn_label().alias("churn_label")
    )


@query
def churn_features(spark, sf_dir):
    numeric = churn.churn_features()
    return features(spark, sf_dir).select(
        "customer_id", *[value.alias(name) for name, value in numeric.items()]
    )


@query
def risk_tiers(spark, sf_dir):
    scores = sample_scores(features(spark, sf_dir), RUN_DATE)
    return scores.select("customer_id", "churn_score", "churn_risk_tier")


def _history(spark, sf_dir) -> DataFrame:
    chosen = features(spark, sf_dir).where(ltv.has_history())
    return chosen.select(
        "customer_id",
        category(ltv.CHANNEL).alias("channel"),
        ltv.target().alias("target"),
    )


@query
def stratified_split(spark, sf_dir):
    history = stage(_history(spark, sf_dir), "history")
    return with_split(history, "customer_id", "channel").drop("target")


@query
def stratified_split_many(spark, sf_dir):
    """Orders split within about a thousand strata."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    rows = orders.select(
        F.col("o_orderkey").cast("string").alias("order_id"), (F.col("o_custkey") % 997).alias("stratum")
    )
    return with_split(stage(rows, "split-orders"), "order_id", "stratum")


@query
def cohort_mean_ltv(spark, sf_dir):
    return ltv.cohort_means(_history(spark, sf_dir))


@query
def cold_start_ltv(spark, sf_dir):
    """Every customer valued at its channel's mean; one channel has none."""
    means = ltv.cohort_means(_history(spark, sf_dir).where("channel <> 'direct'"))
    return ltv.cold_start(features(spark, sf_dir), means)


@query
def regression_metrics(spark, sf_dir):
    """How far cohort means are from the actual spend."""
    history = stage(_history(spark, sf_dir), "history")
    customers = history.withColumnRenamed("channel", ltv.CHANNEL)
    predicted = ltv.cold_start(customers, ltv.cohort_means(history))
    both = history.join(predicted, "customer_id")
    measured = metrics.regression_metrics(both, "target", "ltv_score")
    return measured.select(*[F.col(c).cast("decimal(18,2)").alias(c) for c in measured.columns])


@query
def classification_metrics(spark, sf_dir):
    """The sample scores as churn predictions."""
    chosen = features(spark, sf_dir)
    labelled = sample_scores(chosen, RUN_DATE).join(
        chosen.select("customer_id", churn.churn_label().alias("label")), "customer_id"
    )
    measured = metrics.classification_metrics(labelled, "label", "churn_score")
    return measured.select(*[F.col(c).cast("decimal(9,6)").alias(c) for c in measured.columns])


@query
def segmentation_grid(spark, sf_dir):
    return segmentation.rfm_grid(features(spark, sf_dir))


@query
def rfm_standardization(spark, sf_dir):
    stats = segmentation.grid_statistics(segmentation.rfm_grid(features(spark, sf_dir)))
    return stats.select(*[F.col(c).cast("decimal(9,6)").alias(c) for c in stats.columns])


@query
def model_promotion(spark, sf_dir):
    """Production versions; each month of orders plays one run of each model."""
    month = F.year("ordered_at") * 12 + F.month("ordered_at")
    share = {
        status: F.count_if(F.col("order_status") == status) / F.count(F.lit(1))
        for status in ("completed", "pending")
    }
    monthly = (
        layers(spark, sf_dir)
        .stg_orders.groupBy(month.cast("long").alias("version"))
        .agg(
            F.to_date(F.min("ordered_at")).alias("run_date"),
            share["pending"].alias("silhouette_score"),
            F.expr("sum(cast(total_amount_usd * 100 as bigint)) div count(*)")
            .cast("double")
            .alias("rmse"),
            (share["completed"] * 2).alias("auc_roc"),
        )
    )
    names = F.array(*[F.lit(n) for n in (registry.SEGMENTATION, registry.LTV, registry.CHURN)])
    return registry.production_versions(
        monthly.select(F.explode(names).alias("model_name"), "*")
    )


@query
def score_fallback(spark, sf_dir):
    """Scores combined when only active customers have a fresh churn score."""
    chosen = features(spark, sf_dir)
    fresh = sample_scores(chosen, RUN_DATE, keep="is_active")
    yesterday = sample_scores(chosen, RUN_DATE - timedelta(days=1))
    half = (F.col("churn_score") / 2).cast("decimal(5,4)")
    prior = yesterday.withColumn("churn_score", half).withColumn(
        "churn_risk_tier", risk_tier(F.col("churn_score"))
    )
    combined = scoring.combine_scores(
        chosen,
        fresh.select("customer_id", "segment_label"),
        fresh.select("customer_id", "ltv_score"),
        fresh.where("is_active").select("customer_id", "churn_score", "churn_risk_tier"),
        prior,
        RUN_DATE,
        "fallback",
        SCORED_AT,
    )
    return combined.withColumn("anomaly_detail", F.to_json("anomaly_detail"))


@query
def ml_score_sink(spark, sf_dir):
    """Two score dates stored under the score constraints; today's partition promoted."""
    chosen = features(spark, sf_dir)
    store = TableStore(spark, scratch_path(spark, "scores"))
    for score_date in (RUN_DATE - timedelta(days=1), RUN_DATE, RUN_DATE):
        scoring.write_scores(store, sample_scores(chosen, score_date), score_date)
    stored = store.read_partitioned(scoring.SCORE_TABLE, ML_SCORES_DDL)
    promoted = marts.mart_ml_scores(stored, RUN_DATE)
    return promoted.withColumn("anomaly_detail", F.to_json("anomaly_detail"))


@query
def score_job(spark, sf_dir):
    """The scoring job on two dates; today the churn model has failed, so customers keep the
    values that yesterday's partition holds. Rows as stored in the mart."""
    chosen = stage(features(spark, sf_dir), "features")
    store = TableStore(spark, scratch_path(spark, "score-job"))
    for score_date, failed in ((RUN_DATE - timedelta(days=1), False), (RUN_DATE, True)):
        made = sample_scores(chosen, score_date)
        half = (F.col("churn_score") / 2).cast("decimal(5,4)")
        risk = made.select("customer_id", half.alias("churn_score"))
        risk = risk.withColumn("churn_risk_tier", risk_tier(F.col("churn_score")))
        results = scoring.ModelResults(
            made.select("customer_id", "segment_label"),
            made.select("customer_id", F.col("ltv_score").cast("double").alias("ltv_score")),
            None if failed else risk,
        )
        scoring.store_scores(store, chosen, results, score_date, "sample", SCORED_AT)
    return store.read(scoring.MART_TABLE).withColumn("anomaly_detail", F.to_json("anomaly_detail"))


@query
def mart_ml_scores(spark, sf_dir):
    chosen = features(spark, sf_dir)
    yesterday = sample_scores(chosen, RUN_DATE - timedelta(days=1))
    scores = yesterday.unionByName(sample_scores(chosen, RUN_DATE))
    promoted = marts.mart_ml_scores(scores, RUN_DATE)
    return promoted.withColumn("anomaly_detail", F.to_json("anomaly_detail"))


# Daily metrics and insights.


def _daily_anomalies(spark, sf_dir) -> DataFrame:
    built = layers(spark, sf_dir)
    daily = anomaly.daily_metrics(
        built.mart_orders, built.stg_events, built.mart_support_tickets
    )
    return anomaly.daily_anomalies(daily)


@query
def anomaly_zscore(spark, sf_dir):
    return _daily_anomalies(spark, sf_dir)


@query
def anomaly_details(spark, sf_dir):
    flagged = anomaly.anomaly_detail(_daily_anomalies(spark, sf_dir))
    return flagged.withColumn("anomaly_detail", F.to_json("anomaly_detail"))


@query
def daily_insight(spark, sf_dir):
    built = layers(spark, sf_dir)
    return insights.daily_insight(built.mart_customer_360, built.mart_orders, RUN_DATE)


# Models; compared by properties in the tests, not by SQL.


@query
def segment_customers(spark, sf_dir):
    return segmentation.train_and_score(features(spark, sf_dir), RUN_DATE).scores


@query
def ltv_scores(spark, sf_dir):
    return ltv.train_and_score(features(spark, sf_dir), RUN_DATE).scores


@query
def churn_scores(spark, sf_dir):
    return churn.train_and_score(features(spark, sf_dir), RUN_DATE).scores


@query
def ml_scores(spark, sf_dir):
    store = TableStore(spark, scratch_path(spark, "model-runs"))
    scores = scoring.score_customers(features(spark, sf_dir), RUN_DATE, SCORED_AT, store=store)
    return scores.withColumn("anomaly_detail", F.to_json("anomaly_detail"))


@query
def ticket_topics(spark, sf_dir):
    return topics.ticket_topics(layers(spark, sf_dir).stg_tickets)


# What is exact about the trained models, compared with SQL.


@query
def segment_inactive(spark, sf_dir):
    """Customers that segmentation leaves out."""
    found = segmentation.train_and_score(features(spark, sf_dir), RUN_DATE).scores
    return found.where(F.col("segment_label") == segmentation.INACTIVE).select("customer_id")


@query
def ltv_bounds(spark, sf_dir):
    """Scores per channel, and how many are null or negative."""
    chosen = features(spark, sf_dir)
    scores = ltv.train_and_score(chosen, RUN_DATE).scores
    joined = chosen.select("customer_id", category(ltv.CHANNEL).alias("channel")).join(scores, "customer_id")
    return joined.groupBy("channel").agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(F.col("ltv_score").isNull() | (F.col("ltv_score") < 0)).alias("out_of_bounds"),
    )


@query
def churn_bounds(spark, sf_dir):
    """Which customers are scored, and whether score and tier agree."""
    scores = churn.train_and_score(features(spark, sf_dir), RUN_DATE).scores
    fits = F.col("churn_score").between(0, 1) & (
        F.col("churn_risk_tier") == risk_tier(F.col("churn_score"))
    )
    return scores.select("customer_id", F.coalesce(fits, F.lit(False)).alias("is_consistent"))


@query
def ml_score_bounds(spark, sf_dir):
    """One score row per customer; churn for the active ones, a segment for all."""
    scores = scoring.score_customers(features(spark, sf_dir), RUN_DATE, SCORED_AT)
    return scores.select(
        "customer_id",
        F.col("churn_score").isNotNull().alias("has_churn"),
        (F.col("segment_label") == segmentation.INACTIVE).alias("is_inactive"),
        (F.col("ltv_score") >= 0).alias("has_value"),
    )


@query
def topic_bounds(spark, sf_dir):
    """Every ticket has a topic with a label and a confidence."""
    found = topics.ticket_topics(layers(spark, sf_dir).stg_tickets)
    fits = F.col("cluster_id").between(0, topics.TOPICS - 1) & F.col("cluster_confidence").between(0, 1)
    return found.select(
        "ticket_id", F.coalesce(fits & (F.col("cluster_label") != ""), F.lit(False)).alias("is_consistent")
    )


@query
def daily_outputs(spark, sf_dir):
    """Anomalies and insights of two run dates as stored, the second one twice; rows per date."""
    store = TableStore(spark, scratch_path(spark, "outputs"))
    anomalies = stage(_daily_anomalies(spark, sf_dir), "anomalies")
    for run_date in (RUN_DATE - timedelta(days=1), RUN_DATE, RUN_DATE):
        insight = daily_insight(spark, sf_dir).withColumn("run_date", F.lit(run_date))
        outputs.store_outputs(store, anomalies.where(F.col("run_date") == F.lit(run_date)), insight)
    parts = [
        store.read_partitioned(name, ddl).groupBy("run_date").agg(F.count(F.lit(1)).alias("row_count")).withColumn("table_name", F.lit(name))
        for name, ddl in ((outputs.ANOMALY_TABLE, ddl_of(anomalies.schema)), (outputs.INSIGHT_TABLE, outputs.INSIGHT_DDL))
    ]
    return reduce(DataFrame.unionByName, parts)
