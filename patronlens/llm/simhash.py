"""Near-duplicate classes by SimHash fingerprints and multi-index hashing.

Two 64-bit fingerprints link when they differ in at most ``distance`` bits. The bits
are cut into three segments. If the segment radii satisfy ``sum(radius + 1) > distance``,
linked fingerprints differ by at most the radius in one segment at least, so the join
is exact: each fingerprint enumerates the ball around each of its segments, looks the
values up in the table of segments and compares the whole fingerprints there.

Copies are collapsed to one fingerprint before anything is enumerated, so the cost
follows the distinct fingerprints. Nothing is capped.

Null and empty texts have fingerprint 0 and link like any other. Rows that share a
``doc_id`` (nulls included) get the component of each of their texts; the smallest
non-null id names a component, or null if it has none.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronlens.llm.components import connected_components
from patronlens.workspace import stage

SHINGLE_WORDS = 4
SEED = 42
DISTANCE = 4


def fingerprint(text: str | None, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Unsigned SimHash of the shingles of ``words`` words; ASCII letters are lower-cased and
    words end at ASCII white space. Repeated shingles count each time."""
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= words:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum([len(w) + 1 for w in found])
    starts = [0, *ends[:-1].tolist()]
    stops = (ends[words - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, stops, strict=False)], "<u8")
    ones = np.zeros(64, np.int64)
    for low in range(0, len(hashes), 1 << 16):
        part = hashes[low : low + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int.from_bytes(bits.tobytes(), "little")


def with_fingerprint(
    df: DataFrame, text: str = "text", column: str = "fingerprint", keep_text: bool = True
) -> DataFrame:
    """Add the fingerprint as a signed long; the text only leaves Python again if it is kept."""
    dropped = {column.lower()} | ({text.lower()} if not keep_text else set())
    out = df.drop(*[c for c in df.columns if c.lower() in dropped])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            values = [fingerprint(t.as_py()) for t in batch.column(names.index(text))]
            signed = pa.array(np.array(values, np.uint64).view(np.int64), pa.int64())
            kept = [i for i, name in enumerate(names) if name.lower() not in dropped]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in kept), signed], names=[*(names[i] for i in kept), column]
            )

    return df.mapInArrow(run, T.StructType([*out.schema.fields, T.StructField(column, T.LongType())]))


def as_hex(value: Column) -> Column:
    """16 lower-case hex digits of a 64-bit value."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def segment_plan(distance: int) -> list[tuple[int, int, int]]:
    """(shift, width, radius) of three segments with ``sum(radius + 1) = distance + 1``.
    A segment with a larger ball gets more bits, which makes its lookups rarer."""
    spare = max(0, distance + 1 - 3)
    radii = [(spare + 2 - i) // 3 for i in range(3)]
    widths = [22, 21, 21] if len(set(radii)) == 1 else [22, 22, 20]
    shifts = [sum(widths[:i]) for i in range(3)]
    return list(zip(shifts, widths, radii, strict=True))


def ball(width: int, radius: int) -> list[int]:
    """All masks of ``width`` bits with at most ``radius`` ones."""
    return [
        sum(1 << b for b in bits) for n in range(radius + 1) for bits in combinations(range(width), n)
    ]


def links(prints: DataFrame, distance: int = DISTANCE, column: str = "fingerprint") -> DataFrame:
    """Pairs ``a < b`` of distinct fingerprints that differ in at most ``distance`` bits.

    ``prints`` has one row per fingerprint. A pair may come up once per segment.
    """
    if distance < 2:
        raise ValueError("three segments need a distance of two or more")
    plan = segment_plan(distance)

    def key(i: int, shift: int, width: int) -> Column:
        # The number of the segment goes above its bits, so one long is the whole key.
        bits = F.shiftrightunsigned(F.col(column), shift).bitwiseAND(F.lit((1 << width) - 1))
        return bits + F.lit(i << 32)

    table = prints.select(
        F.explode(F.array(*[key(i, s, w) for i, (s, w, _) in enumerate(plan)])).alias("key"),
        F.col(column).alias("b"),
    )
    probes = [
        key(i, s, w).bitwiseXOR(F.lit(mask))
        for i, (s, w, radius) in enumerate(plan)
        for mask in ball(w, radius)
    ]
    probe = prints.select(F.explode(F.array(*probes)).alias("key"), F.col(column).alias("a"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    smaller = F.col("a") < F.col("b")
    table = table.withColumnRenamed("key", "table_key")
    return probe.join(table, (F.col("key") == F.col("table_key")) & smaller & near).select("a", "b")


def _named_prints(marked: DataFrame, doc_id: str, distance: int) -> DataFrame:
    """``fingerprint, component_id`` for every distinct fingerprint."""
    prints = marked.groupBy("fingerprint").agg(F.min(doc_id).alias("component_id"))
    prints = stage(prints, "simhash-distinct")
    linked = connected_components(links(prints, distance))
    names = (
        prints.join(linked, F.col("fingerprint") == F.col("node"))
        .groupBy("component")
        .agg(F.min("component_id").alias("linked_id"))
    )
    renamed = linked.join(names, "component").select(F.col("node").alias("fingerprint"), "linked_id")
    # Only fingerprints with a link are in ``renamed``; the rest name themselves.
    named = prints.join(renamed, "fingerprint", "left").select(
        "fingerprint", F.coalesce("linked_id", "component_id").alias("component_id")
    )
    # Written, so that the join with all documents starts from plain shuffles, of which
    # adaptive execution can split a fingerprint that very many documents share.
    return stage(named, "simhash-components")


def near_duplicate_classes(
    df: DataFrame, text: str = "text", doc_id: str = "doc_id", distance: int = DISTANCE
) -> DataFrame:
    """``df`` without its text, with ``fingerprint`` (signed long) and ``component_id``, the
    smallest id that chains of links reach."""
    marked = stage(with_fingerprint(df, text, keep_text=False), "simhash-prints").drop("component_id")
    return marked.join(_named_prints(marked, doc_id, distance), "fingerprint")


def representatives(
    df: DataFrame, text: str = "text", doc_id: str = "doc_id", distance: int = DISTANCE
) -> DataFrame:
    """The ``component_id`` of every class, each once: with unique ids, one document per class."""
    marked = stage(with_fingerprint(df.select(doc_id, text), text, keep_text=False), "simhash-prints")
    return _named_prints(marked, doc_id, distance).select("component_id").distinct()
