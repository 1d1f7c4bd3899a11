import zlib
from collections import Counter, defaultdict

import pytest

from patronlens.llm import queries, sharding

SF = "/root/testdata/sf0.01"


def check_layout(rows, shards):
    sizes = Counter(r.shard for r in rows)
    counts = [sizes.get(s, 0) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_whole_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op4_sharding(spark, SF).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {
        k: (len(t.encode()) + 16, zlib.crc32(t.encode())) for k, t in docs.items()
    }
    assert len(rows) == len(docs) and {r.law for r in rows} == {"rows"}
    check_layout(rows, 40)


@pytest.mark.parametrize("bucket_bytes", [200, 5_000, 1 << 20])
def test_buckets_partitions_and_seeds(spark, bucket_bytes):
    rows = [(i if i % 9 else None, None if i % 7 == 0 else f"text {i % 50}" * (i % 5), "x") for i in range(700)]
    df = spark.createDataFrame(rows, "doc_id long, text string, Shard string")
    def layout(frame, seed=1):
        moved = sharding.external_shuffle(frame, 7, seed, bucket_bytes=bucket_bytes).collect()
        check_layout(moved, 7)
        return sorted((r.shard, r.slot, r.doc_id or -1, r.text or "") for r in moved)
    first = layout(df)
    assert first == layout(df.repartition(13))
    assert first != layout(df, seed=2)
    assert Counter(x[2:] for x in first) == Counter((d or -1, t or "") for d, t, _ in rows)


def test_order_is_mixed(spark):
    df = spark.range(4000).selectExpr("id as doc_id", "repeat('ab', 20) as text")
    rows = sharding.external_shuffle(df, 4, 3, bucket_bytes=20_000).collect()
    ids = [r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    rising = sum(a < b for a, b in zip(ids, ids[1:]))
    assert 0.46 < rising / len(ids) < 0.54
    halves = Counter((r.shard, r.doc_id // 2000) for r in rows)
    assert all(420 < n < 580 for n in halves.values())


def test_empty_table_few_rows_and_files(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "doc_id long, text string")
    check_layout(sharding.external_shuffle(df, 40, 1).collect(), 40)
    assert sharding.external_shuffle(df.limit(0), 40, 1).count() == 0
    sharding.write_shards(sharding.external_shuffle(df, 2, 1), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def brute_force(rows, shards, seed, bucket_bytes, hot=()):
    """Sort each bucket, permute it by its seed, and number all rows: ``shard, slot, id, text``."""
    import numpy as np
    import xxhash

    def spark_hash(value, seed):  # of a long, as Spark computes it
        return xxhash.xxh64_intdigest(int(value).to_bytes(8, "little", signed=True), seed)

    def signed(value):
        return value - (1 << 64) if value >> 63 else value

    def chained(*values, seed=42):
        for value in values:
            seed = seed if value is None else spark_hash(value, seed)
        return signed(seed)

    sized = [(i, zlib.crc32((t or "").encode()), len((t or "").encode()) + 16, t) for i, t in rows]
    buckets = max(1, -(-sum(r[2] for r in sized) // bucket_bytes))
    seen, found = Counter(), defaultdict(list)
    for r in sized:
        at = signed(xxhash.xxh64_intdigest(int(seed).to_bytes(4, "little", signed=True), 42))
        at = chained(r[0], r[1], r[2], seed=at & ((1 << 64) - 1))
        if (r[0], r[3]) in hot:
            at = chained(at, seen[r[0], r[3]])
            seen[r[0], r[3]] += 1
        found[at % buckets].append(r)
    out, position = [], 0
    for bucket in sorted(found):
        own = sorted(found[bucket], key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2], r[3] is None))
        order = np.random.Generator(np.random.PCG64([seed, bucket])).permutation(len(own))
        for place in order:
            shard = position * shards // len(rows)
            out.append((shard, position + (-shard * len(rows)) // shards, own[place][0], own[place][3]))
            position += 1
    return sorted(out, key=str)


def shuffled(spark, rows, shards, seed, bucket_bytes, parts=3):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    moved = sharding.external_shuffle(df, shards, seed, bucket_bytes=bucket_bytes).collect()
    return sorted(((r.shard, r.slot, r.doc_id, r.text) for r in moved), key=str)


def test_against_brute_force(spark):
    rows = [(i if i % 9 else None, None if i % 7 == 0 else f"text {i % 50}" * (i % 5)) for i in range(300)]
    rows.append((7, "long " * 3000))  # larger than a bucket
    for bucket_bytes in (900, 20_000):
        assert shuffled(spark, rows, 7, 5, bucket_bytes) == brute_force(rows, 7, 5, bucket_bytes)


def test_many_equal_rows_fill_no_bucket(spark, monkeypatch):
    rows = [(1, "the same text")] * 5000 + [(None, "nobody's")] * 900 + [(i, f"other {i}") for i in range(1000)]
    hot = {(1, "the same text"), (None, "nobody's")}
    sizes = []
    plain = sharding._first_positions
    monkeypatch.setattr(sharding, "_first_positions", lambda counts: sizes.extend(r.n for r in counts.collect()) or plain(counts))
    first = shuffled(spark, rows, 11, 3, 4000)
    assert max(sizes) * 29 < 2.5 * 4000 and len(sizes) > 30
    assert first == shuffled(spark, rows, 11, 3, 4000, parts=7)
    assert first == brute_force(rows, 11, 3, 4000, hot)
