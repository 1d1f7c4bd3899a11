"""The raw domains, derived from the order/line-item/event sample tables.

Row-wise except campaigns, which are one aggregate per supplier and day. Older
versions of some rows are added so that the staging dedup has work to do, and a
newest version without a customer removes some orders. ``faults=True`` also adds
bad rows for the quality checks.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.sources.raw import RawTables
from patronlens.sources.seeds import seed_rows

RUN_DATE = date(2024, 1, 31)
DAY_SHIFT = 8218  # days that bring the last order to RUN_DATE
LOADED_AT = datetime(2024, 1, 31, 2)
LOADED_EARLIER = LOADED_AT - timedelta(days=1)
LOADED_LATER = LOADED_AT + timedelta(hours=1)

# Channel per market segment.
CHANNEL_BY_SEGMENT = {
    "AUTOMOBILE": "organic",
    "BUILDING": "paid_search",
    "FURNITURE": "social",
    "HOUSEHOLD": "referral",
    "MACHINERY": "direct",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _shifted(name: str) -> Column:
    return (F.col(name) + F.expr(f"interval {DAY_SHIFT} days")).cast("timestamp")


def _lookup(column: Column, pairs: dict[str, str]) -> Column:
    chain = F.when(F.lit(False), F.lit(""))
    for key, value in pairs.items():
        chain = chain.when(column == key, value)
    return chain


def _versions(df: DataFrame, extra: Column, other: datetime) -> DataFrame:
    """Each row at LOADED_AT, and once more at ``other`` with ``is_extra`` set where
    ``extra`` holds."""
    base = F.struct(F.lit(LOADED_AT).alias("_ingested_at"), F.lit(False).alias("is_extra"))
    more = F.struct(F.lit(other).alias("_ingested_at"), F.lit(True).alias("is_extra"))
    versions = F.when(extra, F.array(base, more)).otherwise(F.array(base))
    return df.withColumn("_v", F.explode(versions)).select("*", "_v.*").drop("_v")


def customers(spark: SparkSession, sf_dir: str, faults: bool = False) -> DataFrame:
    source = _table(spark, sf_dir, "customer")
    older = F.col("c_mktsegment") == "BUILDING"
    codes = [row[0] for row in seed_rows("country_codes")]  # one for each nation, in order
    country = F.element_at(F.array(*[F.lit(c) for c in codes]), F.pmod("c_nationkey", F.lit(20)) + 1)
    age = (1 + F.pmod(F.col("c_custkey") * 7919, F.lit(1825))).cast("int")
    email = F.concat(F.lower("c_name"), F.lit("@example.com"))
    if faults:
        low = F.col("c_acctbal") < 0
        country = F.when(low, F.concat(country, F.lit("X"))).otherwise(country)
        email = F.when(F.col("c_acctbal") > 9000, F.lit("shared@example.com")).otherwise(email)
    name = F.when(F.col("is_extra"), F.concat("c_name", F.lit("-old"))).otherwise(F.col("c_name"))
    return _versions(source, older, LOADED_EARLIER).select(
        _text("c_custkey").alias("customer_id"),
        name.alias("name"),
        email.alias("email"),
        _lookup(F.col("c_mktsegment"), CHANNEL_BY_SEGMENT).alias("acquisition_channel"),
        country.alias("country_code"),
        F.date_sub(F.lit(RUN_DATE), age).alias("account_created_at"),
        "_ingested_at",
        F.lit(RUN_DATE).alias("_run_date"),
    )


def orders(spark: SparkSession, sf_dir: str, faults: bool = False) -> DataFrame:
    source = _table(spark, sf_dir, "orders")
    pending = F.col("o_orderstatus") == "P"
    withdrawn = pending & (F.col("o_orderpriority") == "1-URGENT")
    even = F.pmod("o_custkey", F.lit(2)) == 0
    status = (
        F.when(F.col("o_orderstatus") == "F", "completed")
        .when(F.col("o_orderstatus") == "O", "pending")
        .when(even, "cancelled")
        .otherwise("refunded")
    )
    total = F.col("o_totalprice").cast("decimal(12,2)")
    customer = F.when(~F.col("is_extra"), _text("o_custkey"))
    if faults:
        low = F.col("o_orderpriority") == "5-LOW"
        total = F.when(pending & low, -total).otherwise(total)
        status = F.when((F.col("o_orderstatus") == "O") & low, "lost").otherwise(status)
        high = F.col("o_orderpriority") == "2-HIGH"
        customer = F.when(pending & high, F.concat(F.lit("gone-"), customer)).otherwise(customer)
    return _versions(source, withdrawn, LOADED_LATER).select(
        _text("o_orderkey").alias("order_id"),
        customer.alias("customer_id"),
        status.alias("order_status"),
        total.alias("total_amount_usd"),
        _shifted("o_orderdate").alias("ordered_at"),
        "_ingested_at",
        F.lit(RUN_DATE).alias("_run_date"),
    )


def order_items(spark: SparkSession, sf_dir: str, faults: bool = False) -> DataFrame:
    source = _table(spark, sf_dir, "lineitem")
    quantity = F.col("l_quantity").cast("int")
    price = F.col("l_extendedprice").cast("decimal(12,2)") / quantity.cast("decimal(10,0)")
    order = _text("l_orderkey")
    if faults:
        order = F.when(F.col("l_quantity") >= 50, F.concat(F.lit("gone-"), order)).otherwise(order)
    parts = [_text(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    return source.select(
        F.concat_ws("-", *parts).alias("order_item_id"),
        order.alias("order_id"),
        _text("l_partkey").alias("product_id"),
        quantity.alias("quantity"),
        price.cast("decimal(10,2)").alias("unit_price_usd"),
        F.lit(LOADED_AT).alias("_ingested_at"),
        F.lit(RUN_DATE).alias("_run_date"),
    )


def events(spark: SparkSession, sf_dir: str, faults: bool = False) -> DataFrame:
    source = _table(spark, sf_dir, "events")
    user = _text("user_id")
    device = F.element_at(
        F.array(F.lit("desktop"), F.lit("mobile"), F.lit("tablet")),
        (F.pmod("event_id", F.lit(3)) + 1).cast("int"),
    )
    kind = F.when(F.col("is_extra"), "click").otherwise(F.col("event_type"))
    if faults:
        wild = F.col("value") > 50
        user = F.when(wild, F.concat(F.lit("gone-"), user)).otherwise(user)
        kind = F.when(F.col("value") >= 2, kind)
    session = F.concat_ws("-", _text("user_id"), F.to_date("ts").cast("string"))
    return _versions(source, F.col("event_type") == "error", LOADED_EARLIER).select(
        _text("event_id").alias("event_id"),
        session.alias("session_id"),
        user.alias("customer_id"),
        kind.alias("event_type"),
        F.concat(F.lit("/"), "event_type").alias("page_url"),
        device.alias("device_type"),
        F.col("ts").cast("timestamp").alias("occurred_at"),
        "_ingested_at",
        F.lit(RUN_DATE).alias("_run_date"),
    )


def campaigns(spark: SparkSession, sf_dir: str, faults: bool = False) -> DataFrame:
    """One campaign per supplier; spend, impressions and clicks per ship day."""
    source = _table(spark, sf_dir, "lineitem")
    spend = F.col("l_extendedprice").cast("decimal(12,2)") * F.col("l_discount").cast(
        "decimal(4,2)"
    )
    quantity = F.col("l_quantity").cast("int")
    shown = F.col("l_linestatus") == "O"
    clicked = shown & (F.col("l_returnflag") == "R")
    if faults:
        clicked = F.col("l_returnflag") == "R"
    daily = source.groupBy("l_suppkey", F.to_date("l_shipdate").alias("ship_day")).agg(
        F.sum(spend).cast("decimal(12,2)").alias("daily_spend_usd"),
        F.coalesce(F.sum(F.when(shown, quantity)), F.lit(0)).cast("int").alias("impressions"),
        F.coalesce(F.sum(F.when(clicked, quantity)), F.lit(0)).cast("int").alias("clicks"),
    )
    even = F.pmod("l_suppkey", F.lit(2)) == 0
    clicks = F.when(F.col("is_extra"), 0).otherwise(F.col("clicks"))
    return _versions(daily, F.col("clicks") > 0, LOADED_EARLIER).select(
        _text("l_suppkey").alias("campaign_id"),
        F.when(even, "google_ads").otherwise("meta_ads").alias("platform"),
        F.concat(F.lit("Campaign "), _text("l_suppkey")).alias("campaign_name"),
        "daily_spend_usd",
        "impressions",
        clicks.alias("clicks"),
        F.date_add("ship_day", DAY_SHIFT).alias("campaign_date"),
        "_ingested_at",
        F.lit(RUN_DATE).alias("_run_date"),
    )


def tickets(spark: SparkSession, sf_dir: str, faults: bool = False) -> DataFrame:
    """One ticket per order; the description is the document with the order's number,
    where there is one."""
    source = _table(spark, sf_dir, "orders")
    priority = F.col("o_orderpriority")
    level = (
        F.when(priority.isin("1-URGENT", "2-HIGH"), "high")
        .when(priority == "3-MEDIUM", "medium")
        .otherwise("low")
    )
    closed = (F.col("o_orderstatus") == "F") & ~F.col("is_extra")
    status = (
        F.when(closed, "closed")
        .when((F.col("o_orderstatus") == "P") & ~F.col("is_extra"), "in_progress")
        .otherwise("open")
    )
    customer = _text("o_custkey")
    if faults:
        status = F.when(priority == "4-NOT SPECIFIED", "on_hold").otherwise(status)
        lost = (F.col("o_orderstatus") == "P") & (priority == "3-MEDIUM")
        customer = F.when(lost, F.concat(F.lit("gone-"), customer)).otherwise(customer)
    opened = _shifted("o_orderdate")
    hours = (1 + F.pmod("o_orderkey", F.lit(240))).cast("int")
    resolved = F.when(closed, opened + F.make_dt_interval(hours=hours))
    subject = F.concat(F.lit("Order "), _text("o_orderkey"), F.lit(": "), priority)
    rows = _versions(source, F.col("o_orderstatus") == "F", LOADED_EARLIER)
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = rows.join(documents, F.col("o_orderkey") == F.col("doc_id"), "left")
    description = F.coalesce("text", subject)
    return rows.select(
        _text("o_orderkey").alias("ticket_id"),
        customer.alias("customer_id"),
        subject.alias("subject"),
        description.alias("description"),
        status.alias("status"),
        level.alias("priority"),
        opened.alias("created_at"),
        resolved.alias("resolved_at"),
        "_ingested_at",
        F.lit(RUN_DATE).alias("_run_date"),
    )


def raw_tables(spark: SparkSession, sf_dir: str, faults: bool = False) -> RawTables:
    return RawTables(
        customers(spark, sf_dir, faults),
        orders(spark, sf_dir, faults),
        order_items(spark, sf_dir, faults),
        events(spark, sf_dir, faults),
        campaigns(spark, sf_dir, faults),
        tickets(spark, sf_dir, faults),
    )
