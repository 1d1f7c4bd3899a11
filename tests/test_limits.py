"""No count of categories, channels, strata or repeated ids changes a method or stops a job."""

from datetime import date, datetime

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from patronlens import runlog
from patronlens.functions.numbers import is_true, number_or, to_number
from patronlens.models import ltv, metrics, registry
from patronlens.models.features import encoded
from patronlens.operators import tiles
from patronlens.workspace import stage


def test_thousands_of_categories_stay_sparse(spark):
    df = spark.range(6000).select("id", F.format_string("v%05d", F.col("id") % 5000).alias("channel"))
    df = df.withColumn("x", F.col("id") * 0.5)
    wide, names = encoded(df, {"x": F.col("x")}, ["channel"], [F.col("id")])
    assert names[0] == "x" and names[1] == "channel_v00000" and len(names) == 5001
    assert wide.columns == ["id", "features"]
    rows = wide.where("id in (0, 4999, 5003)").orderBy("id").select("features").collect()
    assert [sorted(map(int, r.features.indices)) for r in rows] == [[1], [0, 5000], [0, 4]]


def test_encoding_of_an_empty_table(spark):
    df = spark.createDataFrame([], "id long, channel string, x double")
    wide, names = encoded(df, {"x": F.col("x")}, ["channel"], [F.col("id")])
    assert names == ["x"] and wide.select(vector_to_array("features")).count() == 0


def test_thousands_of_channels(spark):
    means = spark.range(5000).select(F.concat(F.lit("c"), "id").alias("channel"), F.col("id").cast("decimal(14,2)").alias("cohort_mean"))
    customers = spark.range(7000).select(F.col("id").cast("string").alias("customer_id"), F.concat(F.lit("c"), "id").alias(ltv.CHANNEL))
    scores = {int(r.customer_id): r.ltv_score for r in ltv.cold_start(customers, means).collect()}
    assert scores[4999] == 4999.0 and scores[5000] == 0.0 and len(scores) == 7000


def test_long_error_texts_are_kept(spark, store):
    def job():
        raise ValueError("x" * 3000)

    with pytest.raises(ValueError):
        runlog.logged_run(store, date(2026, 7, 1), "job", job, now=lambda: datetime(2026, 7, 1))
    events = store.read_log(runlog.EVENT_TABLE, runlog.RUN_EVENT_DDL)
    notes = [r.notes for r in events.collect() if r.notes]
    assert notes == ["x" * 3000]


def test_one_id_may_repeat_more_often_than_a_leaf(spark, monkeypatch):
    monkeypatch.setattr(tiles, "LEAF_ROWS", 20)
    monkeypatch.setattr(tiles, "HISTOGRAM_ROWS", 16)
    df = stage(spark.createDataFrame([("same", 7)] * 90 + [("b", 1)] * 10, "id string, v int"), "tiles")
    key = tiles.ordered_integer(F.col("v"), df.schema["v"].dataType)
    cuts = tiles.rows_at_ranks(df, "id", {"v": key}, lambda _, rows: [5, 50])
    assert cuts["v"] == [tiles.Cut(1, "b"), tiles.Cut(7, "same")]


def test_numbers_and_flags_in_texts(spark):
    texts = ["1d", "2f", "1.5", " 2 ", "nan", "x", "\ttrue", "yes\n", "no", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.orderBy("i").select(to_number(F.col("t")), is_true(df, "t")).collect()
    assert [r[0] for r in got] == [None, None, 1.5, 2.0, None, None, None, None, None, None]
    assert [r[1] for r in got] == [False] * 6 + [True, True, False, False]
    flags = spark.createDataFrame([(float("nan"),), (1.0,), (0.0,), (None,)], "f double")
    assert [r[0] for r in flags.select(is_true(flags, "f")).collect()] == [False, True, False, False]
    assert flags.select(number_or(F.col("f"), 7)).first()[0] == 7.0


def test_a_run_without_a_model_never_becomes_production(spark):
    rows = [(registry.SEGMENTATION, 1, None), (registry.SEGMENTATION, 2, 0.3), (registry.SEGMENTATION, 3, 0.2)]
    runs = spark.createDataFrame(rows, "model_name string, version long, silhouette_score double")
    runs = runs.selectExpr("*", "null rmse", "null auc_roc", "date'2026-07-01' run_date")
    assert [r.version for r in registry.production_versions(runs).collect()] == [2]
    assert registry.production_versions(runs.where("version = 1")).count() == 0


def test_metrics_of_raw_scores(spark):
    """Scores that agree to four decimals are no ties, and 0.49996 is not positive."""
    rows = [(1, 0.49996), (0, 0.49995), (1, 0.50004), (0, 0.50001), (0, 0.1), (1, 0.1), (1, 1.0), (0, 0.0)]
    rows += [(i % 2, i / 977) for i in range(900)]
    df = spark.createDataFrame(rows, "label int, score double")
    got = metrics.classification_metrics(df, "label", "score").first()
    positive, negative = ([s for l, s in rows if l == k] for k in (1, 0))
    wins = sum((p > q) + 0.5 * (p == q) for p in positive for q in negative)
    assert got.auc_roc == pytest.approx(wins / len(positive) / len(negative))
    chosen = [l for l, s in rows if s >= 0.5]
    assert got.precision == pytest.approx(sum(chosen) / len(chosen))
    assert got.recall == pytest.approx(sum(chosen) / len(positive))
