"""Keyed tables: hash buckets that grow with the table, in files that are merged one by one.

**Buckets** follow linear hashing: ``n`` buckets, and the key's hash modulo the power of two above
``n``, or below it where that bucket does not exist yet. From ``n`` to ``n + 1`` one bucket
alone is split. A load raises ``n`` so that a bucket holds ``bucket_bytes`` on average, and rewrites
only the buckets that are split. The number lies in the publication, so older publications read
their own files.

**Files.** A bucket has files of about ``file_bytes``, each written by a task of its own that
second hash of the key selects. Every file has a Bloom filter of its keys. A load merges the
files that may hold one of its keys; all other files stay, named by reference. New keys go to
new files. ``compaction`` joins small files of a bucket.

A filter has no false negatives, so the result is that of a merge with the whole table.
Keys may be of any type and null.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from patronlens.session import ship_package
from patronlens.workspace import content_length, delete_path, stage_at

BITS_PER_KEY = 24
PROBES = 8

#: Hashes that travel in one row, and bytes of a filter that do: a batch of Arrow's 10,000 rows stays at 10 MB.
BLOCK = 128
PIECE_BYTES = 8 * BLOCK

#: Hashes looked up in a filter, or added to it, at a time: eight places each.
AT_ONCE = 1 << 16

_DESCRIPTION = "file string, bucket int, bytes long, rows long, filter binary"
_DESCRIBED = pa.schema(
    [("file", pa.string()), ("bucket", pa.int32()), ("bytes", pa.int64()), ("rows", pa.int64()), ("filter", pa.binary())]
)
_FILE_BLOCKS = pa.schema([("file", pa.string()), ("bucket", pa.int32()), ("bytes", pa.int64()), ("hashes", pa.binary())])
_KEY_BLOCKS = pa.schema([("bucket", pa.int32()), ("data", pa.binary())])


@dataclass(frozen=True)
class Layout:
    """Sizes that a keyed table keeps to."""

    bucket_bytes: int = 512 << 20
    file_bytes: int = 128 << 20


@dataclass(frozen=True)
class StoredFile:
    """A live file: where it lies below the store, and what the publication says of it."""

    part: str
    path: str
    bucket: int
    bytes: int
    rows: int
    buckets: int
    ddl: str


def ddl_of(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


# --- buckets ---


def level_size(buckets: int) -> int:
    """The greatest power of two that is not above ``buckets``."""
    return 1 << (buckets.bit_length() - 1)


def bucket_of(key_hash: Column, buckets: int) -> Column:
    """Bucket of a key among ``buckets``."""
    low = level_size(buckets)
    wide = F.pmod(key_hash, F.lit(2 * low))
    return F.when(wide < buckets, wide).otherwise(wide - low).cast("int")


def split_buckets(before: int, after: int) -> set[int]:
    """Old buckets whose keys are dealt anew when ``before`` buckets become ``after``."""
    found = set()
    for bucket in range(before, after):
        while bucket >= before:
            bucket -= level_size(bucket)
        found.add(bucket)
    return found


# --- filters ---


def _positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Bits of each hash in a filter whose size is a power of two: one row per probe."""
    first, step = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    return np.array([(first + np.uint64(i) * step) & np.uint64(bits - 1) for i in range(PROBES)])


def make_filter(hashes: np.ndarray, keys: int | None = None) -> bytes:
    """``keys`` is the number of different hashes, if some are repeated."""
    bits = 1 << max(6, (BITS_PER_KEY * (len(hashes) if keys is None else keys) - 1).bit_length())
    made = np.zeros(bits // 8, np.uint8)
    for start in range(0, len(hashes), AT_ONCE):
        at = _positions(hashes[start : start + AT_ONCE], bits).ravel()
        np.bitwise_or.at(made, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
    return made.tobytes()


def may_hold(filter_: bytes, hashes: np.ndarray) -> np.ndarray:
    """For each hash whether the filter may hold it; never false for one that it does hold."""
    made = np.frombuffer(filter_, np.uint8)
    at = _positions(hashes, 8 * len(made))
    return ((made[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)


def _cut(of: Sequence, hashes: np.ndarray) -> Iterator[tuple]:
    """Rows of ``(*of, hashes as bytes)`` of at most ``BLOCK`` hashes each."""
    for start in range(0, len(hashes), BLOCK):
        yield *of, hashes[start : start + BLOCK].tobytes()


def _blocks(schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows whose last column is a hash, put together to blocks of hashes that share the other columns. A
    task holds less than a block per value of these beyond the batch that it reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[tuple, np.ndarray] = {}
        for batch in batches:
            hashes = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            full = []
            for of, own in _grouped(batch.columns[:-1]):
                mine = np.concatenate([waiting.pop(of, hashes[:0]), hashes[own]])
                whole = len(mine) - len(mine) % BLOCK
                full += _cut(of, mine[:whole])
                if whole < len(mine):
                    waiting[of] = mine[whole:]
            yield _batch(full, schema)
        yield _batch([row for of, mine in waiting.items() for row in _cut(of, mine)], schema)

    return run


def _grouped(columns: Sequence[pa.Array]) -> Iterator[tuple[tuple, np.ndarray]]:
    """The different rows of ``columns``, each with the places where it stands."""
    codes = [c.dictionary_encode() for c in columns]
    place = np.zeros(len(columns[0]), np.int64)
    for c in codes:
        place = place * max(1, len(c.dictionary)) + c.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(place, kind="stable")
    starts = np.flatnonzero(np.diff(place[order], prepend=-1))
    for own in np.split(order, starts[1:]) if len(order) else ():
        yield tuple(c[int(own[0])].as_py() for c in columns), own


def _batch(rows: Sequence[tuple], schema: pa.Schema) -> pa.RecordBatch:
    values = [list(v) for v in zip(*rows, strict=True)] or [[] for _ in schema]
    return pa.record_batch([pa.array(v, f.type) for v, f in zip(values, schema, strict=True)], schema=schema)


def _bytes(column: pa.Array) -> np.ndarray:
    """The values of a binary column, one after the other, without a copy."""
    column = column.cast(pa.binary())
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per file, from the blocks of its key hashes; they are held as eight bytes each."""
    parts, of = [], None
    for batch in batches:
        of = of or tuple(batch.column(name)[0].as_py() for name in ("file", "bucket", "bytes"))
        parts.append(_bytes(batch.column("hashes")).copy())
    hashes = np.concatenate(parts).view(np.uint64)
    parts.clear()
    hashes.sort()
    keys = 1 + int(np.count_nonzero(hashes[1:] != hashes[:-1]))
    yield _batch([(*of, len(hashes), make_filter(hashes, keys))], _DESCRIBED)


def _probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files that may hold one of the wanted keys of their bucket, from rows in order: the pieces of the
    bucket's filters, then blocks of wanted hashes. Only filters of files not yet found are held."""
    bucket, filters = None, {}
    for batch in batches:
        found = []
        files = batch.column("file").dictionary_encode()
        codes = files.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        buckets = batch.column("bucket").to_numpy(zero_copy_only=False)
        changes = (np.diff(codes) != 0) | (np.diff(buckets) != 0)
        starts = [0, *(np.flatnonzero(changes) + 1).tolist(), batch.num_rows]
        for start, end in zip(starts, starts[1:], strict=False) if batch.num_rows else ():
            if buckets[start] != bucket:
                bucket, filters = buckets[start], {}
            data = _bytes(batch.column("data").slice(start, end - start))
            if codes[start] >= 0:
                name = files.dictionary[int(codes[start])].as_py()
                filters[name] = filters.get(name, b"") + data.tobytes()
                continue
            hashes = data.view(np.uint64)
            for first in range(0, len(hashes), AT_ONCE):
                some = hashes[first : first + AT_ONCE]
                hit = [name for name, filter_ in filters.items() if may_hold(filter_, some).any()]
                found += [(name,) for name in hit]
                for name in hit:
                    del filters[name]
        yield _batch(found, pa.schema([("file", pa.string())]))


# --- reading and writing ---


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def files_with(store, files: Iterable[StoredFile], wanted: DataFrame, keys: Sequence[str]) -> list[StoredFile]:
    """The files that may hold a key of ``wanted``."""
    by_path = {f.path: f for f in files}
    if not by_path:
        return []
    buckets = max(f.buckets for f in by_path.values())
    ship_package(store.spark)
    folders = sorted({path.split("/rows/")[0] for path in by_path})
    filters = store.spark.read.schema(_DESCRIPTION).parquet(*[f"{store.root}/{f}/filters" for f in folders])
    hashed = wanted.select(key_hash(keys).alias("hash")).distinct()
    hashed = hashed.select(bucket_of(F.col("hash"), buckets).alias("bucket"), "hash")
    blocks = hashed.mapInArrow(_blocks(_KEY_BLOCKS), "bucket int, data binary")
    starts = F.explode(F.sequence(F.lit(1), F.length("filter"), F.lit(PIECE_BYTES))).alias("start")
    pieces = filters.select("bucket", "file", "filter", starts).select(
        "bucket", "file", "start", F.substring("filter", F.col("start"), F.lit(PIECE_BYTES)).alias("data")
    )
    both = pieces.unionByName(blocks, allowMissingColumns=True).repartition("bucket")
    ordered = both.sortWithinPartitions("bucket", F.col("file").asc_nulls_last(), "start")
    found = ordered.select("bucket", "file", "data").mapInArrow(_probed, "file string")
    return [by_path[r.file] for r in found.collect() if r.file in by_path]


def write_files(
    store, table: str, folder: str, rows: DataFrame, keys: Sequence[str], buckets: int, layout: Layout, size: int
) -> list[StoredFile]:
    """Write ``rows``, of about ``size`` bytes, as files of the buckets with a filter for each."""
    spark = store.spark
    ship_package(spark)
    hashed = key_hash(keys)
    per_bucket = max(1, -(-min(size, layout.bucket_bytes) // layout.file_bytes))
    # One task per bucket and second hash where all buckets are written; where few are, twice
    # as many tasks as files, so that seldom two of them meet.
    unit = bucket_of(hashed, buckets) * per_bucket + F.pmod(F.xxhash64(F.lit(1), *keys), F.lit(per_bucket))
    tasks = max(1, min(buckets * per_bucket, 2 * (size // layout.file_bytes) + 1))
    dealt = rows.withColumn("_bucket", bucket_of(hashed, buckets)).repartitionById(tasks, unit.cast("int"))
    path = f"{store.root}/{folder}"
    dealt.write.partitionBy("_bucket").parquet(f"{path}/rows")
    ddl = ddl_of(rows.schema)
    written = spark.read.schema(f"{ddl}, _bucket int").parquet(f"{path}/rows")
    # Only the keys are read again, of the new files alone; hashes of a file are shuffled in blocks.
    described = written.select(
        F.substring_index("_metadata.file_path", f"/{folder}/rows/", -1).alias("file"),
        F.col("_bucket").alias("bucket"),
        F.col("_metadata.file_size").alias("bytes"),
        hashed.alias("hash"),
    )
    blocks = described.mapInArrow(_blocks(_FILE_BLOCKS), "file string, bucket int, bytes long, hashes binary")
    described = blocks.groupBy("file").applyInArrow(_described, _DESCRIPTION)
    inside = F.concat(F.lit(f"{folder}/rows/"), "file")
    described.withColumn("file", inside).write.parquet(f"{path}/filters")
    files = spark.read.schema(_DESCRIPTION).parquet(f"{path}/filters").drop("filter").collect()
    label = folder.rsplit("/", 1)[-1]
    return [
        StoredFile(f"{r.bucket:06d}-{label}-{i}", r.file, r.bucket, r.bytes, r.rows, buckets, ddl)
        for i, r in enumerate(sorted(files, key=lambda r: r.file))
    ]


def merge_batch(
    store,
    table: str,
    folder: str,
    files: Sequence[StoredFile],
    batch: DataFrame,
    keys: Sequence[str],
    merge: Callable[[DataFrame, DataFrame], DataFrame],
    layout: Layout,
) -> tuple[list[StoredFile], list[StoredFile]]:
    """Merge ``batch`` into the files that may hold its keys: the files that go and the new ones.

    ``merge(stored rows, batch rows)`` sees the rows of those files only.
    """
    staged, path = stage_at(batch, f"{table}-batch")
    arriving = content_length(store.spark, path)
    before = max((f.buckets for f in files), default=0)
    total = sum(f.bytes for f in files) + arriving
    after = max(1, before, -(-total // layout.bucket_bytes))
    split = split_buckets(before, after) if before else set()
    gone = {f.path: f for f in files if f.bucket in split}
    gone |= {f.path: f for f in files_with(store, files, staged, keys)}
    if not gone and staged.isEmpty():
        return [], []
    stored = store.scan_files(gone.values())
    merged = merge(staged.limit(0) if stored is None else stored, staged)
    size = arriving + sum(f.bytes for f in gone.values())
    fresh = write_files(store, table, folder, merged, keys, after, layout, size)
    delete_path(store.spark, path)
    return list(gone.values()), fresh


# --- compaction ---


def packed(files: Sequence[StoredFile], file_bytes: int) -> list[list[StoredFile]]:
    """First-fit decreasing: files put together in bins of at most ``file_bytes``; bins of one
    file are left out."""
    bins: list[tuple[int, list[StoredFile]]] = []
    for file in sorted(files, key=lambda f: (-f.bytes, f.path)):
        for i, (size, inside) in enumerate(bins):
            if size + file.bytes <= file_bytes:
                bins[i] = (size + file.bytes, [*inside, file])
                break
        else:
            bins.append((file.bytes, [file]))
    return [inside for _, inside in bins if len(inside) > 1]


def new_folder(layer: str, table: str) -> str:
    return f"{layer}/{table}/{uuid.uuid4().hex}"
