import hashlib
"""The distributed tiles and splits against Spark's own window functions."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from patronlens.operators import split, tiles
from patronlens.workspace import stage


def tiled(spark, rows, order):
    df = stage(spark.createDataFrame(rows, "id string, v int"), "tiles")
    key = tiles.ordered_integer(F.col("v"), df.schema["v"].dataType, **order)
    got = tiles.with_tiles(df, "id", {"tile": key})
    first = F.col("v").desc_nulls_first() if order.get("descending") else F.col("v").asc_nulls_last()
    window = Window.partitionBy(F.lit(1)).orderBy(first, "id")
    return got.withColumn("expected", F.ntile(5).over(window)).collect()


@pytest.fixture
def narrow_passes(monkeypatch):
    """Small limits, so that small data goes through every narrowing step."""
    monkeypatch.setattr(tiles, "LEAF_ROWS", 7)
    monkeypatch.setattr(tiles, "HISTOGRAM_ROWS", 16)


DESCENDING = {"descending": True, "nulls_first": True}


@pytest.mark.parametrize("count", [0, 1, 3, 4, 5, 6, 11])
def test_few_rows(spark, count):
    rows = [(f"c{i:03d}", i % 3) for i in range(count)]
    assert all(r.tile == r.expected for r in tiled(spark, rows, {}))


@pytest.mark.parametrize("order", [{}, DESCENDING])
def test_ties_and_nulls(spark, narrow_passes, order):
    picker = random.Random(5)
    rows = [(f"c{i:05d}", picker.choice([None, 1, 1, 1, 2, 400, -7])) for i in range(300)]
    assert all(r.tile == r.expected for r in tiled(spark, rows, order))


def test_one_value_for_nearly_all_rows(spark, narrow_passes):
    rows = [(f"Customer#{i:09d}", 1 if i % 50 else i) for i in range(400)]
    assert all(r.tile == r.expected for r in tiled(spark, rows, {}))


def test_ids_of_different_length_and_script(spark, narrow_passes):
    ids = ["a", "aa", "aaaaaaaaaaaa", "é", "z", "zebra-zebra-zebra", "日本"]
    rows = [(f"{i}{n}", 3) for i in ids for n in range(12)]
    assert all(r.tile == r.expected for r in tiled(spark, rows, {}))


def test_decimals_count_in_their_smallest_unit(spark, narrow_passes):
    df = spark.range(200).select(
        F.col("id").cast("string").alias("id"),
        (F.pmod(F.col("id") * 7919, F.lit(97)) / 100).cast("decimal(14,2)").alias("v"),
    )
    df = stage(df, "tiles")
    key = tiles.ordered_integer(F.col("v"), df.schema["v"].dataType)
    got = tiles.with_tiles(df, "id", {"tile": key}, tiles=4)
    window = Window.partitionBy(F.lit(1)).orderBy("v", "id")
    rows = got.withColumn("expected", F.ntile(4).over(window)).collect()
    assert all(r.tile == r.expected for r in rows)


def test_rows_outside_the_ordering_get_no_tile(spark):
    df = stage(spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int"), "tiles")
    key = F.when(F.col("id") == "a", F.col("v").cast("long"))
    rows = {r.id: r.tile for r in tiles.with_tiles(df, "id", {"tile": key}).collect()}
    assert rows == {"a": 1, "b": None}


def test_text_cannot_be_ordered(spark):
    df = spark.createDataFrame([("a",)], "v string")
    with pytest.raises(TypeError):
        tiles.ordered_integer(F.col("v"), df.schema["v"].dataType)


def test_split_holds_out_a_fifth_of_each_stratum(spark, narrow_passes):
    rows = [(f"c{i}", "big" if i < 90 else "small") for i in range(101)]
    df = stage(spark.createDataFrame(rows, "id string, g string"), "split")
    got = split.with_split(df, "id", "g").collect()
    held_out = {g: sum(r.is_validation for r in got if r.g == g) for g in ("big", "small")}
    assert held_out == {"big": 18, "small": 3}
    assert len(got) == 101
    again = {r.id: r.is_validation for r in split.with_split(df, "id", "g").collect()}
    assert again == {r.id: r.is_validation for r in got}


def plain_split(rows, fraction=(1, 5)):
    """Held-out ids by sorting each stratum."""
    top, bottom = fraction
    groups = {}
    for i, g in rows:
        groups.setdefault(g or "", []).append((int(hashlib.md5(i.encode()).hexdigest()[:15], 16), i))
    held = -(-len(rows) * top // bottom)
    if min(map(len, groups.values())) < 2 or min(held, len(rows) - held) < len(groups):
        return {i for _, i in sorted(x for g in groups.values() for x in g)[:held]}
    extra = held - sum(len(g) * top // bottom for g in groups.values())
    first = sorted(groups, key=lambda g: (-(len(groups[g]) * top % bottom), g))[:extra]
    quota = {g: len(v) * top // bottom + (g in first) for g, v in groups.items()}
    return {i for g, v in groups.items() for _, i in sorted(v)[: quota[g]]}


@pytest.mark.parametrize("strata", [1, 5, 257, 1500])
@pytest.mark.parametrize("slot_rows", [20, 50_000])
def test_split_of_any_number_of_strata(spark, strata, slot_rows, monkeypatch):
    monkeypatch.setattr(split, "SLOT_ROWS", slot_rows)
    rows = [(f"c{i}", f"g{i % strata}") for i in range(strata * 7)]
    rows += [(f"h{i}", "g0" if strata < 9 else None) for i in range(4000)]
    df = stage(spark.createDataFrame(rows, "id string, g string"), "split")
    got = {r.id for r in split.with_split(df, "id", "g").where("is_validation").collect()}
    assert got == plain_split(rows)
    assert len(got) >= 0.2 * len(rows)


def test_split_as_one_warns(spark, caplog):
    """One-row strata, and more strata than held-out rows."""
    for rows in (
        [(f"c{i}", "one" if i == 0 else "rest") for i in range(10)],
        [(f"c{i}", f"g{i // 2}") for i in range(10)],
    ):
        df = stage(spark.createDataFrame(rows, "id string, g string"), "split")
        caplog.clear()
        got = {r.id for r in split.with_split(df, "id", "g").where("is_validation").collect()}
        assert got == plain_split(rows) and len(got) == 2
        assert "splitting 10 rows as one" in caplog.text


def test_split_of_nothing(spark):
    df = spark.createDataFrame([], "id string, g string")
    assert split.with_split(df, "id", "g").columns == ["id", "g", "is_validation"]
