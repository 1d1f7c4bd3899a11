"""Keyed tables: growing buckets, file filters, compaction."""

import random
import tracemalloc
from datetime import timedelta

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from patronlens.operators.upsert import replace_by_key, upsert
from patronlens.sources import keyed
from patronlens.sources.keyed import Layout, bucket_of, may_hold, packed, split_buckets
from patronlens.sources.tables import TableStore
from tests.conftest import LOADED_AT

TABLE = "k string, v int, _ingested_at timestamp"
LATER = LOADED_AT + timedelta(days=1)


def by_key(old, new):
    return upsert(old, new, ["k"])


def table(spark, rows):
    return spark.createDataFrame(rows, TABLE)


def numbers(spark, low, high, add=0):
    """Rows of incompressible width, so that sizes follow counts."""
    return spark.range(low, high).selectExpr(
        "concat('key-', sha1(cast(id as string))) as k", f"cast(id + {add} as int) as v",
        "timestamp'2026-07-01 02:00:00' as _ingested_at",
    )


def load(store, batch, merge=by_key):
    changed, whole = store.merge_keyed("t", batch, ["k"], merge)
    store.publish(changed)
    return whole


def test_every_bucket_is_split_alone(spark):
    """From n to n + 1 buckets only the keys of one bucket move, half of them to the new one."""
    hashes = spark.range(3000).select(F.xxhash64("id").alias("h"))
    for n in range(1, 20):
        moved = hashes.select(bucket_of(F.col("h"), n).alias("a"), bucket_of(F.col("h"), n + 1).alias("b"))
        rows = moved.where("a <> b").distinct().collect()
        assert len(rows) == 1 and rows[0].b == n and split_buckets(n, n + 1) == {rows[0].a}
    assert split_buckets(1, 9) == {0} and split_buckets(3, 4) == {1} and split_buckets(4, 6) == {0, 1}


def test_filters_have_no_false_negatives():
    pick = np.random.default_rng(1)
    for n in (1, 7, 5000):
        held = pick.integers(0, 1 << 63, n, dtype=np.uint64)
        made = keyed.make_filter(held)
        assert may_hold(made, held).all()
        assert may_hold(made, pick.integers(0, 1 << 63, 20_000, dtype=np.uint64)).mean() < 0.002


def test_filters_are_made_and_read_in_bounded_memory():
    """Beyond the hashes a task holds the filter and a few of them at a time, not eight places of each."""
    hashes = np.random.default_rng(2).integers(0, 1 << 63, 1_000_000, dtype=np.uint64)
    blocks = [pa.record_batch({"file": ["f"], "bucket": [0], "bytes": [9], "hashes": [hashes.tobytes()]})]
    tracemalloc.start()
    (described,) = keyed._described(iter(blocks))
    assert tracemalloc.get_traced_memory()[1] < 60 << 20
    filter_ = described.column("filter")[0].as_py()
    wanted = [(0, "f", filter_), (0, None, hashes[:512].tobytes()), (0, None, hashes.tobytes())]
    schema = pa.schema([("bucket", pa.int32()), ("file", pa.string()), ("data", pa.binary())])
    tracemalloc.reset_peak()
    found = list(keyed._probed(iter([keyed._batch(wanted, schema)])))
    tracemalloc.stop()
    assert [b.column("file").to_pylist() for b in found] == [["f"]]
    assert described.column("rows").to_pylist() == [1_000_000] and may_hold(filter_, hashes[:1000]).all()


def test_hashes_travel_in_blocks_of_one_file():
    schema = pa.schema([("file", pa.string()), ("bucket", pa.int32()), ("hashes", pa.binary())])
    rows = [(f"f{i % 3}" if i < 4000 else "f9", i % 3, i) for i in range(9000)]
    columns = [list(c) for c in zip(*rows, strict=True)]
    batches = [
        pa.record_batch([pa.array(c[i : i + 2500], t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.int64()), strict=True)], names=["file", "bucket", "hash"])
        for i in range(0, 9000, 2500)
    ]
    made = [r for b in keyed._blocks(schema)(iter([*batches, batches[0].slice(0, 0)])) for r in b.to_pylist()]
    assert all(len(r["hashes"]) <= 8 * keyed.BLOCK for r in made) and len(made) < 9000 // keyed.BLOCK + 8
    back = [(r["file"], r["bucket"], int(h)) for r in made for h in np.frombuffer(r["hashes"], np.int64)]
    assert sorted(back) == sorted(rows)


def test_files_of_large_and_repeated_batches_are_found(spark, tmp_path):
    """Several filters longer than a piece in one bucket, several buckets, blocks of many keys, keys that repeat."""
    store = TableStore(spark, str(tmp_path / "s"), Layout(bucket_bytes=400_000, file_bytes=100_000))
    load(store, numbers(spark, 0, 20_000))
    files = store.files("t")
    assert max(f.rows for f in files) * keyed.BITS_PER_KEY // 8 > keyed.PIECE_BYTES and max(f.buckets for f in files) > 1
    again = numbers(spark, 5_000, 9_000).unionByName(numbers(spark, 5_000, 9_000))
    assert {f.path for f in keyed.files_with(store, files, again, ["k"])} == {f.path for f in files}
    one = numbers(spark, 123, 124)
    assert 1 <= len(keyed.files_with(store, files, one, ["k"])) <= 2
    assert keyed.files_with(store, files, numbers(spark, 0, 0), ["k"]) == []
    assert sum(f.rows for f in files) == 20_000


def test_a_table_grows_by_splits_and_equals_a_plain_upsert(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"), Layout(bucket_bytes=60_000, file_bytes=30_000))
    plain = numbers(spark, 0, 0)
    seen = []
    for low, high, add in ((0, 1500, 0), (1200, 3000, 7), (100, 160, 9), (3000, 6500, 0), (6400, 9000, 1)):
        batch = numbers(spark, low, high, add)
        load(store, batch)
        plain = spark.createDataFrame(by_key(plain, batch).collect(), TABLE)
        files = store.files("t")
        seen.append((max(f.buckets for f in files), sum(f.bytes for f in files), store.publication(), plain))
        assert sorted(map(tuple, store.read("t").collect())) == sorted(map(tuple, plain.collect()))
        assert sum(f.rows for f in files) == plain.count()
        assert max(f.bytes for f in files) < 2 * 30_000
    buckets = [b for b, *_ in seen]
    assert len(set(buckets)) >= 4 and buckets == sorted(buckets) and buckets[-1] >= 4 * buckets[0]
    assert all(size <= b * 60_000 for b, size, *_ in seen)
    for _, _, number, rows in seen:  # older publications read their own files
        assert sorted(map(tuple, store.as_of(number).read("t").collect())) == sorted(map(tuple, rows.collect()))
    with pytest.raises(ValueError):
        store.as_of(1).publish({"x": store.write("x", spark.range(1))})


def test_a_small_batch_rewrites_few_files(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"), Layout(bucket_bytes=60_000, file_bytes=20_000))
    load(store, numbers(spark, 0, 20_000))
    files = store.files("t")
    before, buckets = {f.path for f in files}, max(f.buckets for f in files)
    assert len(before) > 40
    batch = numbers(spark, 77, 78, 5).unionByName(numbers(spark, 20_000, 20_001))  # 0.01 % of the keys
    load(store, batch)
    after = {f.path for f in store.files("t")}
    split = split_buckets(buckets, max(f.buckets for f in store.files("t")))
    gone = [f for f in files if f.path not in after and f.bucket not in split]
    assert len(split) <= 1 and len(gone) <= 2 and len(before - after) <= 6
    assert store.read("t").count() == 20_001
    (changed,) = store.rows_with_keys("t", numbers(spark, 77, 78), ["k"]).collect()
    assert changed.v == 82
    load(store, numbers(spark, 30_000, 30_010))  # new keys touch no old file
    assert len(after - {f.path for f in store.files("t")}) <= 4  # at most one bucket is split


def test_replace_by_key_and_null_keys(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"))
    replace = lambda old, new: replace_by_key(old, new, ["k"])
    load(store, table(spark, [("a", 1, LOADED_AT), (None, 2, LOADED_AT)]), replace)
    load(store, table(spark, [("a", 3, LATER), ("b", 4, LATER)]), replace)
    rows = {(r.k, r.v) for r in store.read("t").collect()}
    assert rows == {("a", 3), ("b", 4), (None, 2)}


def test_an_empty_batch_changes_nothing(spark, store):
    load(store, table(spark, [("a", 1, LOADED_AT)]))
    number = store.publication()
    changed, whole = store.merge_keyed("t", table(spark, []), ["k"], by_key)
    assert changed == {} and whole.count() == 1
    store.publish(changed)
    assert store.publication() == number and store.read("t").count() == 1
    assert store.merge_keyed("none", table(spark, []), ["k"], by_key)[1].count() == 0


def test_compaction_keeps_rows_and_old_publications(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"), Layout(bucket_bytes=80_000, file_bytes=40_000))
    for number in range(8):
        load(store, numbers(spark, 150 * number, 150 * (number + 1)))
    rows = sorted(map(tuple, store.read("t").collect()))
    before, number = store.files("t"), store.publication()
    store.publish(store.compact("t", ["k"]))
    after = store.files("t")
    buckets = max(f.buckets for f in after)
    assert len(before) >= 8 and len(after) <= sum(f.bytes for f in before) // 40_000 + buckets
    assert sorted(map(tuple, store.read("t").collect())) == rows
    assert len(store.as_of(number).read("t").collect()) == len(rows)
    assert store.compact("t", ["k"]) == {}
    load(store, numbers(spark, 100, 120, 3))
    assert store.read("t").where("v between 103 and 122").count() >= 20
    assert store.drop_old(keep=1) >= len(before)
    assert store.read("t").count() == len(rows)


def test_first_fit_decreasing():
    def file(size):
        return keyed.StoredFile("p", f"f{size}-{random.random()}", 0, size, 1, 1, "")

    sizes = [30, 70, 50, 20, 60, 10, 100, 40]
    bins = packed([file(s) for s in sizes], 100)
    assert all(sum(f.bytes for f in inside) <= 100 and len(inside) > 1 for inside in bins)
    kept = len(sizes) - sum(len(b) for b in bins) + len(bins)
    assert kept <= sum(sizes) // 100 + 1
