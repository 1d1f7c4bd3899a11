"""Checks, assertion queries and gates."""

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from patronlens.models.tiers import risk_tier, rounded_score
from patronlens.operators.orphans import orphan_rows
from patronlens.quality import assertions, checks, gate, suites
from patronlens.schema import DQ_FAILURE_DDL, RAW_DDL, raw_schema
from patronlens.sources.raw import RawTables
from tests.conftest import LOADED_AT, RUN_DATE


def report(df, *declared):
    flat = [c for d in declared for c in (d if isinstance(d, list) else [d])]
    rows = checks.check_table("t", df, flat, RUN_DATE).collect()
    return {(r.check_name, r.column_name): r for r in rows}


def test_declared_checks_are_complete():
    raw = suites.raw_suites()
    counts = {table: len(declared) for table, declared in raw.items()}
    assert counts == {"customers": 13, "orders": 11, "events": 9, "campaigns": 16, "tickets": 13}
    models = [c for declared in suites.model_suites().values() for c in declared]
    by_name = {name: sum(c.name == name for c in models) for name in {c.name for c in models}}
    assert len(models) == 161
    assert by_name == {
        "not_null": 109,
        "unique": 17 + 1,
        "in_set": 13,
        "expression_is_true": 9,
        "recency": 6,
        "relationship": 4,
        "between": 2,
    }


def test_five_percent_nulls_pass_and_more_fail(spark):
    df = spark.range(100).select(
        F.when(F.col("id") >= 5, F.col("id")).alias("exact"),
        F.when(F.col("id") >= 6, F.col("id")).alias("above"),
    )
    rows = report(df, checks.not_null("exact", "above", mostly="0.95"))
    assert rows["not_null", "exact"].success and rows["not_null", "exact"].unexpected_count == 5
    assert not rows["not_null", "above"].success


def test_value_checks(spark):
    df = spark.createDataFrame(
        [("a", "US", 1, 2), ("b", "USA", -1, 5), (None, None, None, None), ("a", "DE", 0, 0)],
        "kind string, country string, low int, high int",
    )
    rows = report(
        df,
        checks.unique("kind"),
        checks.in_set("kind", ["a"]),
        checks.length_equals("country", 2),
        checks.between("low", low=0),
        checks.at_least("low", "high"),
        checks.holds("high >= 1", "high"),
        checks.exists("kind", "gone"),
        checks.not_null("gone"),
        checks.unique("gone"),
    )
    found = {key: (row.unexpected_count, row.success) for key, row in rows.items()}
    assert found == {
        ("unique", "kind"): (2, False),
        ("in_set", "kind"): (1, False),
        ("length_equals", "country"): (1, False),
        ("between", "low"): (1, False),
        ("pair_at_least", "low, high"): (2, False),
        ("expression_is_true", "high >= 1"): (1, False),
        ("column_exists", "kind"): (0, True),
        ("column_exists", "gone"): (1, False),
        ("not_null", "gone"): (None, False),
        ("unique", "gone"): (None, False),
    }


def test_an_empty_table_passes(spark):
    df = spark.createDataFrame([], "a int, _run_date date")
    rows = report(
        df, checks.not_null("a", mostly="0.95"), checks.unique("a"), checks.recent("_run_date")
    )
    assert all(r.success for r in rows.values())


@pytest.mark.parametrize("age,success", [(0, True), (1, True), (2, False)])
def test_recency_is_a_warning(spark, age, success):
    df = spark.createDataFrame([(RUN_DATE - timedelta(days=age),)], "_run_date date")
    row = report(df, checks.recent("_run_date"))["recency", "_run_date"]
    assert row.success == success and row.severity == "warn"


def test_gate_logs_failures_and_survives_a_broken_log(spark, store, monkeypatch):
    df = spark.createDataFrame([(None,), (1,)], "a int")
    found = checks.check_table("t", df, checks.not_null("a"), RUN_DATE)
    assert gate.run_gate(found, store, RUN_DATE, "crm", "suite", LOADED_AT) is False
    logged = store.read_log(gate.FAILURE_TABLE, DQ_FAILURE_DDL).collect()
    assert [(r.table_name, r.failing_column) for r in logged] == [("t", "a")]

    def broken(*_):
        raise OSError("no space")

    monkeypatch.setattr(store, "append", broken)
    assert gate.run_gate(found, store, RUN_DATE, "crm", "suite", LOADED_AT) is False
    warned = checks.check_table("t", df.select(F.lit(date(2020, 1, 1)).alias("d")),
                                [checks.recent("d")], RUN_DATE)
    assert gate.run_gate(warned, store, RUN_DATE, "crm", "suite", LOADED_AT) is True


def test_sample_rows_as_json(spark):
    rows = spark.createDataFrame([(2, "b"), (1, "a")], "id int, v string")
    sample = gate.sample_json(rows, "id").first().sample_failing_rows
    assert sample == '[{"id":1,"v":"a"},{"id":2,"v":"b"}]'


def empty(spark, table):
    return spark.createDataFrame([], RAW_DDL[table])


def test_integrity_error_lists_every_relation(spark):
    at = datetime(2026, 6, 1)
    one = Decimal(1)
    raw = RawTables(
        spark.createDataFrame(
            [("c1", "n", "e", "organic", "US", RUN_DATE, LOADED_AT, RUN_DATE)],
            raw_schema("customers"),
        ),
        spark.createDataFrame(
            [(f"o{i}", c, "completed", one, at, LOADED_AT, RUN_DATE)
             for i, c in enumerate(["c1", "cX", "cX", "cY"])],
            raw_schema("orders"),
        ),
        spark.createDataFrame(
            [("i1", "o9", "p", 1, one, LOADED_AT, RUN_DATE)], raw_schema("order_items")
        ),
        spark.createDataFrame(
            [("e1", "s", None, "click", "/", "web", at, LOADED_AT, RUN_DATE)], raw_schema("events")
        ),
        empty(spark, "campaigns"),
        empty(spark, "tickets"),
    )
    with pytest.raises(AssertionError) as error:
        assertions.assert_referential_integrity(raw)
    text = str(error.value)
    assert "orders.customer_id: 3" in text and "order_items.order_id: 1" in text
    assert "events.customer_id: 1" in text and "tickets" not in text
    found = orphan_rows(raw.orders, F.col("order_id"), "customer_id", raw.customers, "customer_id")
    assert sorted(r.order_id for r in found.collect()) == ["o1", "o2", "o3"]
    nulls = orphan_rows(raw.events, F.col("event_id"), "customer_id", raw.customers, "customer_id")
    assert nulls.count() == 1


@pytest.mark.parametrize(
    "prior,current,deviation",
    [(None, 10, None), (10, 12, None), (10, 13, "0.3"), (10, 8, None), (100, 79, "0.21"), (10, 0, None)],
)
def test_volume_drift(spark, prior, current, deviation):
    days = [RUN_DATE] * current
    days += [RUN_DATE - timedelta(days=2)] * (prior or 0) + [RUN_DATE - timedelta(days=9)] * 50 * (
        prior is not None
    )
    df = spark.createDataFrame([(d,) for d in days], "_run_date date")
    rows = assertions.volume_drift(df, RUN_DATE).collect()
    assert [r.deviation_pct for r in rows] == ([Decimal(deviation)] if deviation else [])


def test_freshness_limits(spark):
    def arrived(age):
        return spark.createDataFrame([(LOADED_AT - age,)], "_ingested_at timestamp")

    tables = {
        "pass": arrived(timedelta(days=1)),
        "warn": arrived(timedelta(days=2)),
        "error": arrived(timedelta(days=2, seconds=1)),
    }
    rows = assertions.freshness(tables, LOADED_AT).collect()
    assert all(r.table_name == r.status for r in rows)


def test_tiers_fit_stored_scores(spark):
    raw = [0.3299, 0.33, 0.32996, 0.6699, 0.67, -0.1, 1.2]
    df = spark.createDataFrame([(v,) for v in raw], "p double")
    scored = df.select("p", rounded_score(F.col("p")).alias("churn_score")).withColumn(
        "churn_risk_tier", risk_tier(F.col("churn_score"))
    )
    tiers = {r.p: r.churn_risk_tier for r in scored.collect()}
    assert tiers == {
        0.3299: "Low", 0.33: "Medium", 0.32996: "Medium", 0.6699: "Medium", 0.67: "High",
        -0.1: "Low", 1.2: "High",
    }
    complete = scored.select(
        F.lit("c").alias("customer_id"), F.lit(RUN_DATE).alias("score_date"),
        F.lit(1).alias("ltv_score"), "churn_score", "churn_risk_tier",
    )
    assert assertions.score_violations(complete).isEmpty()
