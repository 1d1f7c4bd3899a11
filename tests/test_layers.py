"""Staging and intermediate rules, and the feature mart's invariants."""

from datetime import date, datetime, timedelta
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from patronlens.plans import intermediate, marts, staging
from patronlens.schema import raw_schema
from tests.conftest import LOADED_AT, RUN_DATE

relaxed = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def customer(number, version=0, name=None):
    return (
        f"c{number}",
        name or f"n{number}-{version}",
        f"{number}@x",
        "organic",
        "US",
        date(2025, 7, 1),
        LOADED_AT + timedelta(minutes=version),
        RUN_DATE,
    )


def order(number, customer_id="c1", version=0, total="10.00", at=None, status="completed"):
    at = at or datetime(2026, 6, 1, 12)
    loaded = LOADED_AT + timedelta(minutes=version)
    return (f"o{number}", customer_id, status, Decimal(total), at, loaded, RUN_DATE)


def items(*counts):
    return [
        (f"i{n}-{i}", f"o{n}", "p", 1, Decimal("1.00"), LOADED_AT, RUN_DATE)
        for n, count in counts
        for i in range(count)
    ]


def raw(spark, table, rows):
    return spark.createDataFrame(rows, raw_schema(table))


@relaxed
@given(versions=st.sets(st.tuples(st.integers(0, 9), st.integers(0, 200)), min_size=1, max_size=60))
def test_staging_keeps_exactly_the_newest_version(spark, versions):
    rows = [customer(n, v) for n, v in versions]
    kept = staging.stg_customers(raw(spark, "customers", rows)).collect()
    newest = {}
    for number, version in versions:
        newest[f"c{number}"] = max(version, newest.get(f"c{number}", 0))
    assert {r.customer_id: r.name for r in kept} == {
        c: f"n{c[1:]}-{v}" for c, v in newest.items()
    }
    assert len(kept) == len(newest)


def test_equal_versions_are_decided_the_same_way_every_time(spark):
    rows = [customer(1, name="b"), customer(1, name="a"), customer(1, name="c")]
    for arranged in (rows, rows[::-1]):
        df = raw(spark, "customers", arranged).repartition(3)
        assert [r.name for r in staging.stg_customers(df).collect()] == ["c"]


def test_newest_version_without_customer_removes_the_order(spark):
    rows = [order(1), order(1, None, version=5), order(2), order(3, None)]
    kept = staging.stg_orders(raw(spark, "orders", rows)).collect()
    assert [r.order_id for r in kept] == ["o2"]


def test_narrow_staging_sees_the_same_survivors(spark):
    rows = [
        ("e1", "s", "c1", "click", "/b", "web", datetime(2026, 6, 1, 1), LOADED_AT, RUN_DATE),
        ("e1", "s", "c1", "view", "/a", "web", datetime(2026, 6, 1, 2), LOADED_AT, RUN_DATE),
    ]
    df = raw(spark, "events", rows)
    wide = staging.stg_events(df).select("occurred_at").collect()
    assert wide == staging.stg_events(df, wide=False).select("occurred_at").collect()


def test_campaign_without_impressions_and_open_ticket(spark):
    rows = [("k", "google_ads", "n", Decimal("1"), 0, 0, RUN_DATE, LOADED_AT, RUN_DATE)]
    campaigns = staging.stg_campaigns(raw(spark, "campaigns", rows))
    assert campaigns.first().click_through_rate is None
    assert marts.mart_campaigns(campaigns, RUN_DATE).first().click_through_rate == 0
    opened = datetime(2026, 6, 1)
    rows = [
        ("t1", "c", "s", "d", "open", "low", opened, None, LOADED_AT, RUN_DATE),
        ("t2", "c", "s", "d", "closed", "low", opened, opened + timedelta(minutes=20), LOADED_AT,
         RUN_DATE),
    ]
    tickets = marts.mart_support_tickets(
        staging.stg_tickets(raw(spark, "tickets", rows)), RUN_DATE
    )
    hours = {r.ticket_id: r.resolution_hours for r in tickets.collect()}
    assert hours == {"t1": None, "t2": Decimal("0.33")}


@relaxed
@given(
    orders=st.lists(
        st.tuples(st.decimals(0, 50_000, places=2), st.integers(0, 10)), min_size=1, max_size=20
    )
)
def test_average_item_value_rounds_half_up(spark, orders):
    rows = [order(n, total=str(total)) for n, (total, _) in enumerate(orders)]
    counts = [(n, count) for n, (_, count) in enumerate(orders) if count]
    df = intermediate.int_orders_with_items(
        staging.stg_orders(raw(spark, "orders", rows)),
        staging.stg_order_items(raw(spark, "order_items", items(*counts))),
        RUN_DATE,
    )
    got = {r.order_id: r.avg_item_value_usd for r in df.collect()}
    assert got == {
        f"o{n}": (orders[n][0] / count).quantize(Decimal("0.01"), "ROUND_HALF_UP")
        for n, count in counts
    }


def test_order_windows_at_their_edges(spark):
    ages = [365, 366, 30, 31, 60, 61, -2]
    noon = datetime(2026, 7, 1, 12)
    rows = [order(i, at=noon - timedelta(days=a), total="1.00") for i, a in enumerate(ages)]
    joined = intermediate.int_orders_with_items(
        staging.stg_orders(raw(spark, "orders", rows)),
        staging.stg_order_items(raw(spark, "order_items", items(*[(i, 1) for i in range(7)]))),
        RUN_DATE,
    )
    row = intermediate.int_customer_orders(joined, RUN_DATE).first()
    assert row.total_order_count == 7 and row.total_spend_usd == Decimal("7.00")
    assert row.order_frequency_365d == 6  # all but the one 366 days old
    assert row.order_count_last_30d == 2  # 30 days old, and the one after the run date
    assert row.order_count_prior_30d == 2  # 31 and 60
    assert row.days_since_last_order == -2


@relaxed
@given(
    offsets=st.lists(st.lists(st.integers(0, 86_400), min_size=1, max_size=12), max_size=10)
)
def test_session_duration_is_last_minus_first(spark, offsets):
    start = datetime(2026, 6, 1)
    rows = [
        (f"s{s}", start + timedelta(seconds=o)) for s, all_ in enumerate(offsets) for o in all_
    ]
    df = spark.createDataFrame(rows, "session_id string, occurred_at timestamp")
    got = {
        r.session_id: r.session_duration_seconds
        for r in intermediate.int_sessions(df, RUN_DATE).collect()
    }
    assert got == {f"s{s}": max(all_) - min(all_) for s, all_ in enumerate(offsets)}


METRICS_DDL = (
    "customer_id string, total_order_count long, total_spend_usd decimal(14,2), "
    "order_frequency_365d long, total_spend_365d_usd decimal(14,2), order_count_last_30d long, "
    "order_count_prior_30d long, days_since_last_order int, _run_date date"
)
profile = st.fixed_dictionaries(
    {
        "frequency": st.integers(0, 40),
        "days": st.none() | st.integers(0, 5000),
        "spend": st.decimals(0, 100_000, places=2),
        "has_row": st.booleans(),
    }
)


def features_of(spark, people):
    ids = [(f"c{i:03d}", "organic", 365, RUN_DATE) for i in range(len(people))]
    customers = spark.createDataFrame(
        ids, "customer_id string, acquisition_channel string, customer_tenure_days int, _run_date date"
    )
    rows = [
        (f"c{i:03d}", p["frequency"], p["spend"], p["frequency"], p["spend"], 0, 0, p["days"],
         RUN_DATE)
        for i, p in enumerate(people)
        if p["frequency"] or p["has_row"]
    ]
    events = "customer_id string, most_recent_event_date date, days_since_last_event int, _run_date date"
    tickets = "customer_id string, open_ticket_count long, _run_date date"
    joined = marts.customer_metrics(
        customers,
        spark.createDataFrame(rows, METRICS_DDL),
        spark.createDataFrame([], events),
        spark.createDataFrame([], tickets),
    )
    count = spark.createDataFrame([(3,)], "active_campaign_count long")
    return marts.mart_customer_360(joined, count, RUN_DATE).orderBy("customer_id").collect()


def expected_tiles(active, key):
    ordered = sorted(active, key=key)
    size, extra = divmod(len(ordered), 5)
    sizes = [size + (t < extra) for t in range(5)]
    tiles = [t + 1 for t, s in enumerate(sizes) for _ in range(s)]
    return dict(zip([i for i, _ in ordered], tiles))


@relaxed
@given(people=st.lists(profile, min_size=1, max_size=40))
def test_feature_mart_invariants(spark, people):
    rows = features_of(spark, people)
    assert [r.customer_id for r in rows] == [f"c{i:03d}" for i in range(len(people))]
    active = [(i, p) for i, p in enumerate(people) if p["frequency"] >= 1]
    never = 10**6
    recency = expected_tiles(
        active, lambda x: (-(never if x[1]["days"] is None else x[1]["days"]), x[0])
    )
    frequency = expected_tiles(active, lambda x: (x[1]["frequency"], x[0]))
    monetary = expected_tiles(active, lambda x: (x[1]["spend"], x[0]))
    for i, row in enumerate(rows):
        scores = (row.recency_score, row.frequency_score, row.monetary_score)
        assert scores == (recency.get(i, 0), frequency.get(i, 0), monetary.get(i, 0))
        assert row.rfm_score == "R{}F{}M{}".format(*scores)
        assert row.is_active == (people[i]["frequency"] >= 1)
        known = people[i]["frequency"] or people[i]["has_row"]
        days = people[i]["days"] if known else None
        assert row.recency_days == min(999 if days is None else days, 999)
        assert row.active_campaign_count == 3


def test_customer_dimension_counts_events_as_activity(spark):
    customers = spark.createDataFrame(
        [(c, c, c, "organic", "US", date(2020, 1, 1), 10, RUN_DATE) for c in "abc"],
        "customer_id string, name string, email string, acquisition_channel string, "
        "country_code string, account_created_at date, customer_tenure_days int, _run_date date",
    )
    orders = spark.createDataFrame([("a", 1), ("b", 0)], "customer_id string, order_frequency_365d long")
    events = spark.createDataFrame(
        [("b", 365), ("c", 366)], "customer_id string, days_since_last_event int"
    )
    rows = marts.mart_customers(customers, orders, events, RUN_DATE).collect()
    assert {r.customer_id: r.is_active for r in rows} == {"a": True, "b": True, "c": False}


def test_active_campaign_count_filters_before_the_dedup(spark):
    def day(number, age, spend):
        on = RUN_DATE - timedelta(days=age)
        return (f"k{number}", "google_ads", "n", Decimal(spend), 1, 0, on, LOADED_AT, RUN_DATE)

    rows = [day(1, 30, "1"), day(2, 31, "1"), day(3, 0, "0"), day(4, -5, "2"), day(1, 29, "1")]
    campaigns = staging.stg_campaigns(raw(spark, "campaigns", rows), wide=False)
    assert marts.active_campaign_count(campaigns, RUN_DATE).first()[0] == 3
    empty = campaigns.where(F.lit(False))
    assert marts.active_campaign_count(empty, RUN_DATE).first()[0] == 0
