"""Declared checks, evaluated with one aggregate per table.

All row-level checks of a table share one scan and one map-side aggregate. Each
uniqueness check counts rows per key and each relationship check counts child
rows per key before joining, so hot keys stay cheap. Null values fail only the
not-null checks; an empty table passes value checks.

With row keys a report also has a sample of the failing rows, from the same scan: keys fall into
``SAMPLE_CLASSES`` classes by their digest, each class keeps the failing key with the smallest
digest, and the ``SAMPLE_ROWS`` smallest of these are shown. Counts and samples are one
aggregate, combined before its shuffle, however many rows fail.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from decimal import Decimal
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.operators.orphans import orphan_total, rows_per_key

REPORT_DDL = (
    "table_name string, check_name string, column_name string, severity string, "
    "element_count long, unexpected_count long, success boolean"
)

SAMPLE_ROWS = 20
SAMPLE_CLASSES = 256


@dataclass(frozen=True)
class Check:
    """``fails`` gives a row-level condition; the other kinds need no condition."""

    name: str
    columns: tuple[str, ...]
    fails: Callable[[], Column] | None = None
    kind: str = "rows"  # rows, exists, unique, parent, recent
    mostly: Decimal = Decimal(1)
    severity: str = "error"
    parent: tuple[str, str] | None = None
    detail: str = ""
    bounds: tuple = ()  # the declared values, for display

    @property
    def label(self) -> str:
        return self.detail or ", ".join(self.columns)


def exists(*columns: str) -> list[Check]:
    return [Check("column_exists", (c,), kind="exists") for c in columns]


def not_null(*columns: str, mostly: str = "1") -> list[Check]:
    return [
        Check("not_null", (c,), lambda c=c: F.col(c).isNull(), mostly=Decimal(mostly))
        for c in columns
    ]


def unique(*columns: str) -> Check:
    return Check("unique", columns, kind="unique")


def in_set(column: str, values: Iterable) -> Check:
    accepted = tuple(values)
    return Check("in_set", (column,), lambda: ~F.col(column).isin(*accepted), bounds=accepted)


def length_equals(column: str, length: int) -> Check:
    return Check(
        "length_equals", (column,), lambda: F.length(column) != length, bounds=(length,)
    )


def between(column: str, low=None, high=None) -> Check:
    def fails() -> Column:
        below = F.col(column) < low if low is not None else F.lit(False)
        above = F.col(column) > high if high is not None else F.lit(False)
        return below | above

    return Check("between", (column,), fails, bounds=(low, high))


def at_least(larger: str, smaller: str) -> Check:
    return Check("pair_at_least", (larger, smaller), lambda: F.col(larger) < F.col(smaller))


def holds(expression: str, *columns: str) -> Check:
    return Check(
        "expression_is_true", columns, lambda: ~F.expr(expression), detail=expression
    )


def refers_to(column: str, parent_table: str, parent_column: str) -> Check:
    return Check("relationship", (column,), kind="parent", parent=(parent_table, parent_column))


def recent(column: str) -> Check:
    return Check("recency", (column,), kind="recent", severity="warn")


def _passes(elements: Column, unexpected: Column, mostly: Decimal) -> Column:
    share = F.lit(mostly).cast("decimal(5,4)")
    return (elements - unexpected) >= elements * share


def _result(
    check: Check, table: str, elements: Column, unexpected: Column, sample: Column | None = None
) -> Column:
    shown = [] if sample is None else [sample.alias("sample_failing_rows")]
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(check.name).alias("check_name"),
        F.lit(check.label).alias("column_name"),
        F.lit(check.severity).alias("severity"),
        elements.cast("long").alias("element_count"),
        unexpected.cast("long").alias("unexpected_count"),
        F.coalesce(_passes(elements, unexpected, check.mostly), F.lit(False)).alias("success"),
        *shown,
    )


def key_digest(key: Column) -> Column:
    """The first 32 bits of the key's MD5."""
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("long")


def classed(key: Column) -> Column:
    return key_digest(key) % SAMPLE_CLASSES


def smallest(key: Column, fails: Column) -> Column:
    """The failing key of a class with the smallest digest."""
    return F.min(F.when(fails, F.struct(key_digest(key).alias("digest"), key.alias("key"))))


def shown(firsts: Column) -> Column:
    """The sample as a JSON array of keys, from the smallest of each class; null if none fails."""
    few = F.slice(F.array_sort(F.array_compact(firsts)), 1, SAMPLE_ROWS)
    keys = F.to_json(F.array_sort(F.transform(few, lambda x: x["key"])))
    return F.when(F.size(few) > 0, keys)


def _row_results(df: DataFrame, table: str, checks: Sequence[Check], key: Column) -> DataFrame:
    """Row-level checks with samples: every row is counted as number -1 and as the number of
    each check that it fails."""
    present = set(df.columns)
    known = [(i, c) for i, c in enumerate(checks) if present.issuperset(c.columns)]
    failed = [F.when(F.coalesce(c.fails(), F.lit(False)), F.lit(i)) for i, c in known]
    numbers = F.explode(F.array_compact(F.array(F.lit(-1), *failed))).alias("number")
    rows = df.select(F.coalesce(key, F.lit("")).alias("key"), numbers)
    wrong = F.col("number") >= 0
    class_ = F.when(wrong, classed(F.col("key"))).otherwise(F.lit(-1)).alias("class")
    per_class = rows.groupBy("number", class_).agg(
        F.count(F.lit(1)).alias("n"), smallest(F.col("key"), wrong).alias("first")
    )
    per_check = per_class.groupBy("number").agg(F.sum("n").alias("n"), shown(F.collect_list("first")).alias("sample"))
    found = per_check.agg(
        F.map_from_entries(F.collect_list(F.struct("number", F.struct("n", "sample")))).alias("found")
    )
    total = F.coalesce(F.element_at("found", F.lit(-1))["n"], F.lit(0))
    results = []
    for i, check in enumerate(checks):
        mine = F.element_at("found", F.lit(i))
        count = F.coalesce(mine["n"], F.lit(0)) if present.issuperset(check.columns) else F.lit(None).cast("long")
        results.append(_result(check, table, total, count, mine["sample"]))
    return found.select(F.inline(F.array(*results)))


def _scan_results(df: DataFrame, table: str, checks: Sequence[Check], as_of: date) -> DataFrame:
    """All checks that one aggregate can answer."""
    present = set(df.columns)
    totals = [F.count(F.lit(1)).alias("n")]
    for index, check in enumerate(checks):
        if not present.issuperset(check.columns):
            continue
        if check.kind == "rows":
            totals.append(F.count_if(check.fails()).alias(f"c{index}"))
        elif check.kind == "recent":
            oldest = F.lit(as_of - timedelta(days=1))
            stale = F.max(F.col(check.columns[0])) < oldest
            totals.append(F.coalesce(stale, F.lit(False)).cast("int").alias(f"c{index}"))
    results = []
    for index, check in enumerate(checks):
        elements, unexpected = F.col("n"), F.col(f"c{index}")
        if check.kind == "exists":
            elements = F.lit(1)
            unexpected = F.lit(0 if check.columns[0] in present else 1)
        elif check.kind == "recent":
            elements = F.lit(1)
        if check.kind != "exists" and not present.issuperset(check.columns):
            unexpected = F.lit(None).cast("long")
        results.append(_result(check, table, elements, unexpected))
    return df.agg(*totals).select(F.inline(F.array(*results)))


def _unique_result(df: DataFrame, table: str, check: Check, sampled: bool = False) -> DataFrame:
    if not set(df.columns).issuperset(check.columns):
        unknown = F.lit(None).cast("long")
        return df.agg(F.count(F.lit(1)).alias("n")).select(
            F.inline(F.array(_result(check, table, F.col("n"), unknown)))
        )
    rows = df.select(*check.columns).dropna()
    per_key = rows.groupBy(*check.columns).agg(F.count(F.lit(1)).alias("n"))
    key = F.concat_ws(":", *[F.col(c).cast("string") for c in check.columns])
    return _counted_keys(per_key, F.col("n") > 1, key, table, check, sampled)


def _counted_keys(
    per_key: DataFrame, fails: Column, key: Column, table: str, check: Check, sampled: bool
) -> DataFrame:
    """The result of a check on keys that are counted in ``n``."""

    def total(rows: Column) -> Column:
        return F.coalesce(F.sum(rows), F.lit(0))

    if not sampled:
        totals = per_key.agg(total(F.col("n")).alias("elements"), total(F.when(fails, F.col("n"))).alias("wrong"))
        return totals.select(F.inline(F.array(_result(check, table, F.col("elements"), F.col("wrong")))))
    classes = per_key.groupBy(classed(key).alias("class")).agg(
        F.sum("n").alias("n"), F.sum(F.when(fails, F.col("n"))).alias("bad"), smallest(key, fails).alias("first")
    )
    totals = classes.agg(
        total(F.col("n")).alias("elements"),
        total(F.col("bad")).alias("wrong"),
        shown(F.collect_list("first")).alias("sample"),
    )
    return totals.select(F.inline(F.array(_result(check, table, F.col("elements"), F.col("wrong"), F.col("sample")))))


def _parent_result(
    df: DataFrame, table: str, check: Check, tables: Mapping[str, DataFrame], sampled: bool = False
) -> DataFrame:
    parent, key = check.parent
    if sampled:
        marked = rows_per_key(df, check.columns[0], tables[parent], key, skip_null_keys=True)
        value = F.col("key").cast("string")
        return _counted_keys(marked, F.col("known").isNull(), value, table, check, sampled)
    total = orphan_total(table, df, check.columns[0], tables[parent], key, skip_null_keys=True)
    result = _result(check, table, F.col("child_count"), F.col("orphan_count"))
    return total.select(F.inline(F.array(result)))


def check_table(
    table: str,
    df: DataFrame,
    checks: Sequence[Check],
    as_of: date,
    tables: Mapping[str, DataFrame] | None = None,
    row_key: Column | None = None,
) -> DataFrame:
    """One report row per check, with a sample of the failing rows' keys if ``row_key`` is given. A check on
    keys, unique or relationship, shows those instead."""
    sampled = row_key is not None
    rows = [c for c in checks if c.kind == "rows"]
    scanned = [c for c in checks if c.kind in ("exists", "recent") or c.kind == "rows" and not sampled]
    parts = [_row_results(df, table, rows, row_key)] if rows and sampled else []
    if scanned:
        plain = _scan_results(df, table, scanned, as_of)
        parts.append(plain.withColumn("sample_failing_rows", F.lit(None).cast("string")) if sampled else plain)
    parts += [_unique_result(df, table, c, sampled) for c in checks if c.kind == "unique"]
    parts += [_parent_result(df, table, c, tables or {}, sampled) for c in checks if c.kind == "parent"]
    return reduce(partial(DataFrame.unionByName, allowMissingColumns=True), parts)


def check_tables(
    tables: Mapping[str, DataFrame],
    suites: Mapping[str, Sequence[Check]],
    as_of: date,
    row_keys: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """The report of all suites. ``tables`` may hold further parent tables; with ``row_keys``, the key
    columns per table, the report has samples."""

    def key(table: str) -> Column | None:
        return F.concat_ws(":", *[F.col(k).cast("string") for k in row_keys[table]]) if row_keys else None

    parts = [
        check_table(table, tables[table], checks, as_of, tables, key(table)) for table, checks in suites.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def columns_needed(table: str, suites: Mapping[str, Sequence[Check]]) -> list[str]:
    """Columns of ``table`` that its own checks or relationship checks of others read."""
    own = [c for check in suites.get(table, []) for c in check.columns]
    as_parent = [
        check.parent[1]
        for checks in suites.values()
        for check in checks
        if check.parent and check.parent[0] == table
    ]
    return list(dict.fromkeys(own + as_parent))
