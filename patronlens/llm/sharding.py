"""Uniformly shuffled shards by a two-pass external shuffle.

Pass one scatters the rows by a seeded hash into buckets of about ``bucket_bytes``,
pass two loads one bucket at a time and permutes it (Fisher-Yates, seeded by the bucket).
The buckets one after the other are a random order of all rows; shard ``s`` of ``S`` gets
the positions from ``ceil(s N / S)`` on, so that row counts differ by one at most.

The order depends on the rows and the seed alone, not on partitions, retries or arrival.
Rows that agree in id and text are interchangeable. Where they are many they would fill a
bucket; such rows are numbered, and the number enters the hash as well: counts per range of
rows and their offsets, so that no group meets in one task. A text larger than a bucket has a bucket
almost to itself. Null ids and texts are values like any other; an empty table gives no rows. The columns ``size``,
``text_crc32``, ``shard`` and ``slot`` replace columns of the same name, all others stay.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronlens.workspace import stage

BUCKET_BYTES = 16 << 20
ROW_BYTES = 16
#: Equal rows are numbered where they take more than this part of a bucket.
HOT_SHARE = 8
_GROUP = 4096


def row_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus a fixed cost per row."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(ROW_BYTES)).cast("long")


def text_crc32(text: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 text; a null counts as empty."""
    return F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long")


def _key(doc_id: str) -> Column:
    return F.xxhash64(F.col(doc_id), F.col("text_crc32"), F.col("size"), F.col("_none"))


def _bucket(doc_id: str, seed: int, buckets: int, number: Column | None = None) -> Column:
    mixed = F.xxhash64(F.lit(seed), F.col(doc_id), F.col("text_crc32"), F.col("size"))
    if number is not None:
        mixed = F.xxhash64(mixed, number)
    return F.pmod(mixed, F.lit(buckets)).cast("long")


def _numbered(df: DataFrame, doc_id: str, frequent: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` whose key is in ``frequent(key)``, with a running ``number`` from 0 per
    key; and the other rows. Which of equal rows gets which number does not matter."""
    rows = stage(df.withColumns({"_row": F.monotonically_increasing_id(), "_key": _key(doc_id)}), "shard-rows")
    known = frequent.select(F.col("key").alias("_key"))
    ours = rows.join(known, "_key", "left_semi").withColumn("_range", F.shiftright("_row", 33))
    by_range = stage(ours.groupBy("_key", "_range").agg(F.count(F.lit(1)).alias("n")), "shard-ranges")
    earlier = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_range.select("_key", "_range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_key", "_range").orderBy("_row")) - 1
    placed = ours.select("_key", "_range", "_row").withColumn("_inside", inside).join(offsets, ["_key", "_range"])
    numbers = placed.select("_row", (F.col("_before") + F.col("_inside")).alias("number"))
    made = ours.drop("_key", "_range").join(numbers, "_row").drop("_row")
    return made, rows.join(known, "_key", "left_anti").drop("_row", "_key")


def _first_positions(counts: DataFrame) -> DataFrame:
    """``bucket, first``: how many rows lie in earlier buckets.

    Summed in two levels, so that the one task that sees all groups gets only one row for
    every 4,096 buckets.
    """
    grouped = counts.withColumn("part", F.floor(F.col("bucket") / _GROUP))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = grouped.groupBy("part").agg(F.sum("n").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return grouped.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(
        parts, "part"
    ).select("bucket", (F.col("before") + F.col("inside")).alias("first"))


def external_shuffle(
    df: DataFrame,
    shards: int,
    seed: int,
    doc_id: str = "doc_id",
    text: str = "text",
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """Whole rows of ``df`` with ``size``, ``text_crc32``, ``shard`` and ``slot`` (gapless from 0)."""
    made = {"size", "text_crc32", "shard", "slot", "bucket", "first", "number", "_row", "_key", "_range", "_none"}
    df = df.drop(*[c for c in df.columns if c.lower() in made]).withColumns(
        {"size": row_size(F.col(text)), "text_crc32": text_crc32(F.col(text)), "_none": F.col(text).isNull()}
    )
    narrow = stage(df.select(doc_id, "size", "text_crc32", "_none"), "shard-sizes")
    rows, total = narrow.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    buckets = max(1, -(-total // bucket_bytes))
    at = _bucket(doc_id, seed, buckets).alias("bucket")
    copies = narrow.groupBy(_key(doc_id).alias("key")).agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    frequent = stage(copies.where((F.col("n") > 1) & (F.col("bytes") > bucket_bytes // HOT_SHARE)), "shard-frequent")
    if frequent.isEmpty():
        counted, dealt = narrow.select(at), df.withColumn("bucket", at)
    else:
        ours, others = _numbered(df, doc_id, frequent)
        ours = ours.withColumn("bucket", _bucket(doc_id, seed, buckets, F.col("number"))).drop("number")
        dealt = others.withColumn("bucket", at).unionByName(ours)
        dealt = stage(dealt, "shard-dealt")
        counted = dealt.select("bucket")
    first = _first_positions(counted.groupBy("bucket").agg(F.count("*").alias("n")))
    placed = dealt.join(first, "bucket")

    made = [T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())]
    schema = T.StructType([*df.drop("_none").schema.fields, *made])

    def shuffled(key, bucket):
        number, start = key[0].as_py(), bucket.column("first")[0].as_py()
        canonical = pc.sort_indices(
            bucket, sort_keys=[(c, "ascending") for c in (doc_id, "text_crc32", "size", "_none")]
        ).to_numpy()
        # permutation() is a Fisher-Yates shuffle of the canonical order.
        order = np.random.Generator(np.random.PCG64([seed, number])).permutation(canonical)
        position = start + np.arange(len(order), dtype=np.int64)
        shard = position * shards // rows
        slot = position + (-shard * rows) // shards
        moved = bucket.drop_columns(["bucket", "first", "_none"]).take(pa.array(order))
        return moved.append_column("shard", pa.array(shard, pa.int32())).append_column(
            "slot", pa.array(slot, pa.int64())
        )

    return placed.groupBy("bucket").applyInArrow(shuffled, schema)


def write_shards(shuffled: DataFrame, path: str) -> None:
    """Write one folder per shard; the rows of each file are in slot order."""
    shuffled.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
