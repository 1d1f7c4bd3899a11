"""Upserts, replaces, publication and the run log."""

from dataclasses import replace
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from patronlens.operators.upsert import replace_by_key, upsert
from patronlens.plans.ingest import ingest_domain, load_all
from patronlens.plans.pipeline import build_layers
from patronlens.runlog import EVENT_TABLE, mark_failed, record, record_deadline_miss, run_states
from patronlens.schema import DQ_FAILURE_DDL, RAW_DDL, RUN_EVENT_DDL, raw_schema
from patronlens.sources.raw import RawTables, read_database, read_raw, with_known_parent
from patronlens.sources.seeds import SEED_DDL, read_seed
from patronlens.sources.tables import TableStore, layer_of
from patronlens.workspace import clear_scratch, scratch_path, scratch_root, stage
from tests.conftest import LOADED_AT, RUN_DATE

TABLE = "k string, v int, _ingested_at timestamp"
LATER = LOADED_AT + timedelta(days=1)


def table(spark, *rows):
    return spark.createDataFrame(list(rows), TABLE)


def test_upsert_keeps_the_first_arrival_and_the_last_value(spark):
    old = table(spark, ("a", 1, LOADED_AT), ("b", 1, LOADED_AT))
    batch = table(spark, ("b", None, LATER), ("c", 2, LOADED_AT), ("c", 3, LATER))
    rows = {tuple(r) for r in upsert(old, batch, ["k"]).collect()}
    assert rows == {("a", 1, LOADED_AT), ("b", None, LOADED_AT), ("c", 3, LATER)}
    fresh = {tuple(r) for r in upsert(old, batch, ["k"], refresh_version=True).collect()}
    assert ("b", None, LATER) in fresh
    again = upsert(upsert(old, batch, ["k"]), batch, ["k"])
    assert {tuple(r) for r in again.collect()} == rows


def test_replace_by_key_keeps_rows_missing_from_the_batch(spark):
    old = table(spark, ("a", 1, LOADED_AT), ("b", 1, LOADED_AT))
    batch = table(spark, ("b", 2, LATER))
    assert {(r.k, r.v) for r in replace_by_key(old, batch, ["k"]).collect()} == {("a", 1), ("b", 2)}


def test_partition_replace_is_idempotent(spark, store):
    ddl = "v int, _run_date date"
    for day, value in ((1, 10), (2, 20), (2, 21), (2, 21)):
        df = spark.createDataFrame([(value, date(2026, 7, day))], ddl)
        store.write_partition("mart_x", df, "_run_date")
    rows = store.read_partitioned("mart_x", ddl).collect()
    assert sorted(r.v for r in rows) == [10, 21]


def test_layers_follow_the_name_prefix():
    names = ["stg_a", "int_a", "mart_a", "MART_b", "adhoc"]
    assert [layer_of(n) for n in names] == ["staging", "intermediate", "marts", "marts", "public"]


def test_publication_shows_all_tables_or_none(spark, store):
    first = {n: store.write(n, spark.range(1)) for n in ("a", "b")}
    assert not store.exists("a")
    store.publish(first)
    second = {"a": store.write("a", spark.range(2))}
    assert store.read("a").count() == 1
    store.publish(second)
    assert (store.read("a").count(), store.read("b").count()) == (2, 1)


def small_raw(spark):
    at = datetime(2026, 6, 1)
    one = Decimal("10.00")
    audit = (LOADED_AT, RUN_DATE)
    rows = {
        "customers": [(f"c{i}", "n", f"{i}@x", "organic", "US", date(2026, 1, 1), *audit) for i in range(3)],
        "orders": [(f"o{i}", f"c{i % 3}", "completed", one, at, *audit) for i in range(6)],
        "order_items": [(f"i{i}", f"o{i}", "p", 1, one, *audit) for i in range(5)],
        "events": [("e1", "s1", "c1", "click", "/", "web", at, *audit)],
        "campaigns": [("k1", "google_ads", "n", one, 10, 1, RUN_DATE, *audit)],
        "tickets": [("t1", "c1", "s", "text", "open", "low", at, None, *audit)],
    }
    return RawTables(**{t: spark.createDataFrame(r, raw_schema(t)) for t, r in rows.items()})


def states(store):
    return run_states(store.read_log(EVENT_TABLE, RUN_EVENT_DDL)).collect()


def test_load_is_idempotent_and_all_or_nothing(spark, store):
    raw = small_raw(spark)
    assert load_all(store, raw, RUN_DATE) == 17
    assert load_all(store, raw, RUN_DATE) == 17
    assert {name: store.read(name).count() for name, _ in raw.items()}["orders"] == 6

    stray = raw.orders.withColumn("customer_id", F.lit("nobody"))
    with pytest.raises(AssertionError):
        load_all(store, replace(raw, orders=stray), RUN_DATE)
    assert store.read("orders").where("customer_id = 'nobody'").isEmpty()
    assert sorted(r.status for r in states(store)) == ["failed", "success", "success"]


def test_domain_loads_need_customers_first(spark, store):
    raw = small_raw(spark)
    with pytest.raises(RuntimeError, match="load the crm domain first"):
        ingest_domain(store, "events", {"events": raw.events}, RUN_DATE)
    assert ingest_domain(store, "crm", {"customers": raw.customers}, RUN_DATE) == 3
    both = {"orders": raw.orders, "order_items": raw.order_items}
    assert ingest_domain(store, "orders", both, RUN_DATE) == 11
    with pytest.raises(KeyError):
        ingest_domain(store, "weather", {}, RUN_DATE)
    record_deadline_miss(store, RUN_DATE, "ingest_orders", LATER)
    by_job = {(r.job_name, r.status): r for r in states(store)}
    assert by_job["ingest_orders", "success"].rows_ingested == 11
    assert by_job["ingest_orders", "success"].completed_at is not None
    assert ("ingest_events", "failed") in by_job and ("ingest_orders", "sla_miss") in by_job


def customers_of(spark, *rows):
    audit = (LOADED_AT, RUN_DATE)
    made = [(k, "n", email, "organic", "US", date(2026, 1, 1), *audit) for k, email in rows]
    return spark.createDataFrame(made, raw_schema("customers"))


def test_an_email_belongs_to_one_customer_across_loads(spark, store):
    def load(*rows):
        ingest_domain(store, "crm", {"customers": customers_of(spark, *rows)}, RUN_DATE)
        return {r.customer_id: r.email for r in store.read("customers").collect()}

    assert load(("a", "x"), ("b", "y")) == {"a": "x", "b": "y"}
    # c is rejected, a and b may repeat themselves, b takes a new value and so frees its old one
    assert load(("c", "x"), ("a", "x"), ("b", "z")) == {"a": "x", "b": "z"}
    assert load(("c", "y"), ("d", "z")) == {"a": "x", "b": "z", "c": "y"}
    assert load(("e", "y"), ("f", "f"), ("g", "f")) == {"a": "x", "b": "z", "c": "y", "f": "f"}
    index = {r.value: r.key for r in store.read("customers__email").collect()}
    assert index == {"x": "a", "z": "b", "y": "c", "f": "f"}
    logged = store.read_log("dq_failures", DQ_FAILURE_DDL).where("failing_expectation = 'unique'").collect()
    assert sorted(r.sample_failing_rows for r in logged) == ['["c"]', '["d"]', '["e","g"]']


def test_a_closed_gate_stops_a_domain_load(spark, store):
    good = customers_of(spark, ("a", "x"))
    bad = good.withColumn("country_code", F.lit("USA"))
    with pytest.raises(ValueError, match="gate"):
        ingest_domain(store, "crm", {"customers": bad}, RUN_DATE)
    assert not store.exists("customers") and not store.exists("customers__email")
    assert ingest_domain(store, "crm", {"customers": bad}, RUN_DATE, gate=False) == 1


def test_an_empty_parent_is_an_error(spark):
    raw = small_raw(spark)
    known = with_known_parent(raw.orders, "order_id", "customer_id", raw.customers.limit(1))
    assert known.count() == 2
    with pytest.raises(RuntimeError):
        with_known_parent(raw.orders, "order_id", "customer_id", raw.customers.limit(0))


def test_pipeline_reruns_and_keeps_older_dates(spark, store):
    raw = small_raw(spark)
    build_layers(store, raw, RUN_DATE)
    tables = build_layers(store, raw, RUN_DATE)
    assert tables["mart_customer_360"].count() == 3
    assert tables["mart_orders"].count() == 5  # one order has no items
    fewer = replace(raw, orders=raw.orders.where("order_id <> 'o0'"))
    tables = build_layers(store, fewer, RUN_DATE + timedelta(days=1))
    assert tables["mart_customer_360"].count() == 6
    assert store.read("mart_orders").count() == 5  # a vanished order stays
    assert tables["int_orders_with_items"].count() == 4


def test_sources(spark, tmp_path):
    raw = small_raw(spark)
    for name, df in raw.items():
        df.write.parquet(str(tmp_path / name))
    back = read_raw(spark, str(tmp_path))
    assert [df.count() for _, df in back.items()] == [3, 6, 5, 1, 1, 1]
    assert all(df.schema == raw_schema(name) for name, df in back.items())
    with pytest.raises(ValueError):
        read_database(spark, "jdbc:x", "t", "d", 1, 2, 0)
    counts = {name: read_seed(spark, name).count() for name in SEED_DDL}
    assert counts == {"order_statuses": 4, "country_codes": 20, "acquisition_channels": 5}
    paid = read_seed(spark, "order_statuses").where("is_revenue_positive").collect()
    assert [r.status_code for r in paid] == ["completed"]
    assert set(RAW_DDL) == {name for name, _ in raw.items()}
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_seed_from_a_shared_folder(spark, tmp_path):
    read_seed(spark, "order_statuses").coalesce(1).write.option("header", True).csv(
        str(tmp_path / "order_statuses.csv")
    )
    assert read_seed(spark, "order_statuses", str(tmp_path)).count() == 4


def test_store_log_of_an_unused_table_is_empty(spark, tmp_path):
    assert TableStore(spark, str(tmp_path)).read_log("none", "a int").isEmpty()


def test_scratch_is_cleared_for_this_application_only(spark):
    staged = stage(spark.range(3), "x")
    assert staged.count() == 3
    application = spark.sparkContext.applicationId
    assert application in scratch_path(spark, "y") and scratch_root(spark) in scratch_path(spark, "y")
    clear_scratch(spark)
    with pytest.raises(Exception, match="(?i)not exist|not found"):
        staged.count()


def test_frequent_keys_are_looked_up_without_a_join(spark, monkeypatch):
    from patronlens.operators import orphans

    rows = [(f"o{i}", "hot" if i % 3 else "gone-hot" if i % 2 else f"c{i}") for i in range(60)]
    rows += [(f"n{i}", None) for i in range(9)] + [("c6x", "c6x"), ("o3x", "c12")]
    child = spark.createDataFrame(rows, "id string, key string")
    parent = spark.createDataFrame([("hot",), ("c6",), ("c12",), ("o1",)], "key string")
    known = {"hot", "c6", "c12", "o1"}
    for share in (1, 5, 50_000):
        monkeypatch.setattr(orphans, "HOT_SHARE", share)
        flagged = orphans.with_parent_flag(child, F.col("id"), "key", parent, "key").collect()
        assert sorted(r.id for r in flagged) == sorted(r[0] for r in rows)
        assert all(r.has_parent == (r.key in known) for r in flagged)


def test_runs_in_flight_are_marked_failed(spark, store):
    record(store, "r1", RUN_DATE, "job", "running", LOADED_AT)
    record(store, "r2", RUN_DATE, "job", "running", LOADED_AT)
    record(store, "r2", RUN_DATE, "job", "success", LATER, 5, 60)
    record(store, "r3", RUN_DATE, "other", "running", LOADED_AT)
    mark_failed(store, RUN_DATE, "job", LATER)
    found = {r.run_id: (r.status, r.completed_at, r.rows_ingested) for r in states(store)}
    assert found == {
        "r1": ("failed", LATER, None),
        "r2": ("success", LATER, 5),
        "r3": ("running", None, None),
    }
    mark_failed(store, RUN_DATE, "job", LATER)
    assert sorted(r.status for r in states(store)) == ["failed", "failed", "running", "success"]


def test_parts_become_visible_together_and_old_ones_go(spark, store):
    for number in range(4):
        written = store.write_part("m", "2026-07-01", spark.range(number + 1))
        written["a"] = store.write("a", spark.range(10 * number))
        assert number == 0 or store.read("m").count() == number
        store.publish(written)
    store.publish(store.write_part("m", "2026-07-02", spark.range(5)))
    assert store.read("m").count() == 9 and store.read_parts("m", ["2026-07-02"]).count() == 5
    assert store.drop_old(keep=3) == 4
    assert store.drop_old(keep=3) == 0
    assert store.read("m").count() == 9 and store.read("a").count() == 30
    with pytest.raises(ValueError):
        store.drop_old(keep=0)


def test_logs_are_put_together(spark, store):
    ddl = "n int, note string"
    events = lambda: sorted(r.n for r in store.read_log("x", ddl).collect())
    store.compact_log("x", ddl)  # nothing to do
    for n in range(6):
        store.append("x", spark.createDataFrame([(n, "a")], ddl).coalesce(1))
    store.publish({"other": store.write("other", spark.range(1))})
    number, before = store.publication(), store.read_log("x", ddl)
    assert len(before.inputFiles()) == 6
    store.compact_log("x", ddl)
    assert len(store.read_log("x", ddl).inputFiles()) == 1 and events() == list(range(6))
    store.append("x", spark.createDataFrame([(6, "b")], ddl))
    store.compact_log("x", ddl)
    store.append("x", spark.createDataFrame([(7, "b")], ddl).coalesce(1))
    assert events() == list(range(8)) and len(store.read_log("x", ddl).inputFiles()) == 2
    assert before.count() == 6 == store.as_of(number).read_log("x", ddl).count()
    assert store.drop_old(keep=1) == 1 and events() == list(range(8))
