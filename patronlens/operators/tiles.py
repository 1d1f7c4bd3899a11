"""Exact NTILE and exact rank cuts without sorting a whole group in one task.

``ntile(5) over (partition by flag order by value, id)`` sends every row of a
group to one task. Here the rows at the tile starts are found first, by counting
rows per value range and narrowing only the ranges that hold a wanted rank.
Each pass is one map-side aggregation. Once a range holds at most ``LEAF_ROWS``
rows, a window over that range alone names the row. The tile of every row then
follows from comparing it with the cut rows: a projection, without a shuffle.

Values are ordered as integers (see ``ordered_integer``); equal values by id.
A long run of equal values is narrowed further by the bytes of the id, so one
value held by most rows is no special case.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEAF_ROWS = 200_000
HISTOGRAM_ROWS = 32_768  # rows one counting pass may return, over all ranges
NULL_KEY = 2**61  # lies beyond every ordered value
ID_BYTES = 6  # id bytes compared per narrowing step
ID_SPAN = 256**ID_BYTES


@dataclass(frozen=True)
class Cut:
    """Key of the row at one rank."""

    value: int
    row_id: str


@dataclass
class _Range:
    """Rows of one ordering whose current key lies in [low, high]."""

    name: str
    low: int
    high: int
    rows: int
    ranks: dict[int, int]  # rank inside this range -> rank in the whole ordering
    value: int | None = None  # set once all rows share one value
    id_parts: list[int] = field(default_factory=list)  # id bytes all rows share
    uniform: bool = False  # all rows have the same value and id

    @property
    def is_leaf(self) -> bool:
        return self.uniform or self.rows <= LEAF_ROWS


def ordered_integer(
    column: Column, data_type: T.DataType, descending: bool = False, nulls_first: bool = False
) -> Column:
    """An integer that sorts ascending the way ``column`` should sort.

    Takes integers and decimals; decimals count in their smallest unit.
    """
    if isinstance(data_type, T.DecimalType):
        unit = F.lit(10**data_type.scale).cast("decimal(20,0)")
        number = (column * unit).cast("long")
    elif isinstance(data_type, T.IntegralType):
        number = column.cast("long")
    else:
        raise TypeError(f"cannot order {data_type.simpleString()} as an integer")
    if descending:
        number = -number
    return F.coalesce(number, F.lit(-NULL_KEY if nulls_first else NULL_KEY))


def tile_starts(rows: int, tiles: int) -> list[int]:
    """Zero-based ranks at which tiles 2, 3, ... start; the first tiles take the remainder."""
    size, extra = divmod(rows, tiles)
    starts = [tile * size + min(tile, extra) for tile in range(1, tiles)]
    return [start for start in starts if start < rows]


def _id_number(row_id: Column, part: int) -> Column:
    """The ``part``-th group of id bytes as an integer, in byte order."""
    piece = F.substring(F.encode(row_id, "UTF-8"), part * ID_BYTES + 1, ID_BYTES)
    return F.conv(F.rpad(F.hex(piece), 2 * ID_BYTES, "0"), 16, 10).cast("long")


def _key(r: _Range, value: Column, row_id: Column) -> Column:
    return value if r.value is None else _id_number(row_id, len(r.id_parts))


def _member(r: _Range, value: Column, row_id: Column) -> Column:
    inside = value.isNotNull() & _key(r, value, row_id).between(r.low, r.high)
    if r.value is not None:
        inside = (value == r.value) & inside
        for part, shared in enumerate(r.id_parts):
            inside = inside & (_id_number(row_id, part) == shared)
    return inside


def _rows_per_range(
    df: DataFrame,
    orderings: Mapping[str, Column],
    row_id: Column,
    ranges: Sequence[_Range],
    fields: Callable[[_Range, Column], tuple[Column, Column]],
) -> DataFrame:
    """One row per (range, member row), carrying ``fields(range, value)``."""
    members, entries = [], []
    for index, r in enumerate(ranges):
        value = orderings[r.name]
        members.append(_member(r, value, row_id))
        entry = F.struct(F.lit(index).alias("range"), *fields(r, value))
        entries.append(F.when(members[-1], entry))
    inside = df.where(reduce(lambda a, b: a | b, members))
    found = inside.select(F.explode(F.array(*entries)).alias("e"))
    return found.where("e is not null").select("e.*")


def _slot(key: Column, r: _Range, slots: int) -> Column:
    if slots == 1:
        return F.lit(0).cast("long")
    width = F.lit(-(-(r.high - r.low + 1) // slots))
    offset = key - F.lit(r.low)
    return F.round((offset - F.pmod(offset, width)) / width).cast("long")


def _count(df, orderings, row_id, ranges: Sequence[_Range], slots: int) -> list[Row]:
    """Rows and key bounds per slot of each range; at most ``slots`` slots a range."""

    def fields(r: _Range, value: Column):
        key = _key(r, value, row_id)
        return _slot(key, r, slots).alias("slot"), key.alias("key")

    counted = (
        _rows_per_range(df, orderings, row_id, ranges, fields)
        .groupBy("range", "slot")
        .agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
    )
    return sorted(counted.collect())


def _narrow(r: _Range, slots: list) -> list[_Range]:
    """The slots of ``r`` that hold a wanted rank, as tighter ranges."""
    narrowed, before = [], 0
    for _, _, rows, low, high in slots:
        ranks = {rank - before: w for rank, w in r.ranks.items() if before <= rank < before + rows}
        if ranks:
            tight = _Range(r.name, low, high, rows, ranks, r.value, list(r.id_parts))
            if low == high and rows > LEAF_ROWS:
                if r.value is None:
                    tight.value = low
                elif low == 0:
                    tight.uniform = True  # the id has ended: all these rows have one key
                else:
                    tight.id_parts.append(low)
                tight.low, tight.high = 0, ID_SPAN - 1
            narrowed.append(tight)
        before += rows
    return narrowed


def _name_rows(df, orderings, row_id, ranges: Sequence[_Range]) -> dict[str, dict[int, Cut]]:
    def fields(r: _Range, value: Column):
        return value.alias("value"), row_id.alias("row_id")

    rows = _rows_per_range(df, orderings, row_id, ranges, fields)
    position = F.row_number().over(Window.partitionBy("range").orderBy("value", "row_id")) - 1
    wanted = [
        (F.col("range") == index) & F.col("position").isin(*r.ranks)
        for index, r in enumerate(ranges)
    ]
    named = rows.withColumn("position", position).where(reduce(lambda a, b: a | b, wanted))
    cuts: dict[str, dict[int, Cut]] = {}
    for row in named.collect():
        r = ranges[row["range"]]
        cuts.setdefault(r.name, {})[r.ranks[row["position"]]] = Cut(row["value"], row["row_id"])
    return cuts


def _name_uniform_rows(df, orderings, row_id, ranges: Sequence[_Range]) -> dict[str, dict[int, Cut]]:
    """The one key of each range, without ranking its rows."""

    def fields(r: _Range, value: Column):
        return value.alias("value"), row_id.alias("row_id")

    rows = _rows_per_range(df, orderings, row_id, ranges, fields)
    cuts: dict[str, dict[int, Cut]] = {}
    for row in rows.groupBy("range").agg(F.min("value"), F.min("row_id")).collect():
        r = ranges[row["range"]]
        cuts.setdefault(r.name, {}).update(dict.fromkeys(r.ranks.values(), Cut(row[1], row[2])))
    return cuts


def rows_at_ranks(
    df: DataFrame,
    row_id: str,
    orderings: Mapping[str, Column],
    ranks_of: Callable[[str, int], list[int]],
) -> dict[str, list[Cut]]:
    """Keys of the rows at the ranks ``ranks_of(name, rows)`` of each ordering.

    ``orderings`` maps a name to an integer column; rows where it is null are not
    part of that ordering. ``df`` is read several times: pass a written table.
    """
    ident = F.col(row_id).cast("string")
    whole = [_Range(name, -(2**62), 2**62, 0, {}) for name in orderings]
    ranges = []
    for index, _, rows, low, high in _count(df, orderings, ident, whole, 1):
        name = whole[index].name
        ranks = {rank: rank for rank in ranks_of(name, rows)}
        if ranks:
            ranges += _narrow(_Range(name, low, high, rows, ranks), [(index, 0, rows, low, high)])
    cuts: dict[str, dict[int, Cut]] = {}
    while any(not r.is_leaf for r in ranges):
        small = [r for r in ranges if r.is_leaf]
        large = [r for r in ranges if not r.is_leaf]
        counted = _count(df, orderings, ident, large, max(2, HISTOGRAM_ROWS // len(large)))
        for index, r in enumerate(large):
            small += _narrow(r, [slot for slot in counted if slot[0] == index])
        ranges = small
    for name_rows, chosen in (
        (_name_rows, [r for r in ranges if not r.uniform]),
        (_name_uniform_rows, [r for r in ranges if r.uniform]),
    ):
        if chosen:
            for name, found in name_rows(df, orderings, ident, chosen).items():
                cuts.setdefault(name, {}).update(found)
    return {name: [cuts.get(name, {})[k] for k in sorted(cuts.get(name, {}))] for name in orderings}


def at_or_after(value: Column, row_id: str, cut: Cut) -> Column:
    ident = F.col(row_id).cast("string")
    return (value > cut.value) | ((value == cut.value) & (ident >= cut.row_id))


def with_tiles(
    df: DataFrame, row_id: str, orderings: Mapping[str, Column], tiles: int = 5
) -> DataFrame:
    """Add one tile column (1..tiles) per ordering, equal to ``ntile(tiles)`` over
    that ordering with ``row_id`` as tie-break; null where the ordering is null."""
    cuts = rows_at_ranks(df, row_id, orderings, lambda _, rows: tile_starts(rows, tiles))
    columns = {}
    for name, value in orderings.items():
        passed = [F.when(at_or_after(value, row_id, cut), 1).otherwise(0) for cut in cuts[name]]
        columns[name] = F.when(value.isNotNull(), reduce(lambda a, b: a + b, passed, F.lit(1)))
    return df.withColumns(columns)
