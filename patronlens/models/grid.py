"""Rows with equal binned features as counted cells, on which trees are grown.

Numbers are cut into bins at quantiles of a bounded sample, the rows with the smallest hashes of
their id; categories are values, the rarest ones beyond a number taken as one. Rows that
fall into the same cell are counted together, so that the work of a model follows the number of
cells, which is bounded: where there are more than ``MAX_CELLS``, bins and categories become
coarser. Counts and sums are exact and cells are ordered by their bins, so a model does not
depend on partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.workspace import stage

BINS = 32
MAX_CATEGORIES = 200
MAX_CELLS = 100_000
BOUND_ROWS = 20_000
OTHER = "(other)"


@dataclass(frozen=True)
class Binning:
    """Bounds of the numeric features and values of the categorical ones."""

    bounds: Mapping[str, tuple[float, ...]]
    values: Mapping[str, tuple[str, ...]]

    @property
    def keys(self) -> list[str]:
        return [f"_bin_{name}" for name in (*self.bounds, *self.values)]

    @property
    def names(self) -> list[str]:
        """Features of the trees: the numbers, then an entry for every value of a category."""
        return [*self.bounds, *(f"{c}_{v}" for c, values in self.values.items() for v in values)]

    def columns(self) -> dict[str, Column]:
        """The bin of each feature: how many bounds lie below a number, the place of a value."""
        found = {}
        for name, bounds in self.bounds.items():
            above = [(F.col(name) > F.lit(b)).cast("int") for b in bounds]
            found[f"_bin_{name}"] = sum(above[1:], above[0]) if above else F.lit(0)
        for name, values in self.values.items():
            place = F.array_position(F.array(*[F.lit(v) for v in values]), F.col(name)).cast("int")
            last = len(values) - 1 if OTHER in values else -1
            found[f"_bin_{name}"] = F.when(place > 0, place - 1).otherwise(F.lit(last))
        return found

    def matrix(self, cells: pa.Table) -> np.ndarray:
        """A row per cell, a column per feature of ``names``."""
        columns = [cells.column(f"_bin_{name}").to_numpy().astype(np.uint8) for name in self.bounds]
        for name, values in self.values.items():
            place = cells.column(f"_bin_{name}").to_numpy()
            columns += [(place == i).astype(np.uint8) for i in range(len(values))]
        return np.stack(columns, axis=1) if columns else np.zeros((cells.num_rows, 0), np.uint8)


def _bounds(values: np.ndarray, bins: int) -> tuple[float, ...]:
    """At most ``bins - 1`` bounds between the values: halfway between neighbours if there are few,
    else at quantiles."""
    distinct = np.unique(values)
    if len(distinct) <= bins:
        return tuple(((distinct[1:] + distinct[:-1]) / 2).tolist())
    # The greatest value is no bound: nothing lies above it.
    cuts = np.unique(np.quantile(values, np.arange(1, bins) / bins, method="lower"))
    return tuple(cuts[cuts < distinct[-1]].tolist())


def _values(df: DataFrame, column: str, most: int) -> tuple[str, ...]:
    """The most frequent values of a category in value order; more of them than ``most`` are one."""
    counted = df.groupBy(column).count().orderBy(F.col("count").desc(), column).limit(most + 1).collect()
    found = sorted(r[column] for r in counted[: most if len(counted) <= most else most - 1])
    return (*found, OTHER) if len(counted) > most else tuple(found)


def binning(
    df: DataFrame, row_id: str, numeric: Sequence[str], categorical: Sequence[str], bins: int = BINS,
    categories: int = MAX_CATEGORIES,
) -> Binning:
    """Bins for the columns of ``df``, a written table; numbers are doubles, categories are texts
    without nulls."""
    by_hash = df.select(F.xxhash64(row_id).alias("_hash"), row_id, *numeric).orderBy("_hash", row_id)
    sample = by_hash.limit(BOUND_ROWS).toArrow()
    return Binning(
        {name: _bounds(sample.column(name).to_numpy(), bins) for name in numeric},
        {name: _values(df, name, categories) for name in categorical},
    )


def binned(
    df: DataFrame, row_id: str, numeric: Sequence[str], categorical: Sequence[str], keep: Sequence[str], label: str
) -> tuple[DataFrame, Binning]:
    """``keep`` columns and the bins of every row, written once, in at most ``MAX_CELLS`` cells."""
    bins, categories = BINS, MAX_CATEGORIES
    while True:
        found = binning(df, row_id, numeric, categorical, bins, categories)
        rows = stage(df.select(*keep, *[c.alias(n) for n, c in found.columns().items()]), label)
        if bins <= 2 or rows.select(*found.keys).distinct().count() <= MAX_CELLS:
            return rows, found
        bins, categories = bins // 2, max(2, categories // 2)


def counted_cells(rows: DataFrame, keys: Sequence[str], totals: Mapping[str, Column]) -> pa.Table:
    """The cells in the order of their bins, with ``totals`` and their number ``cell``."""
    table = rows.groupBy(*keys).agg(*[c.alias(n) for n, c in totals.items()]).toArrow()
    table = table.sort_by([(k, "ascending") for k in keys]) if keys else table
    return table.append_column("cell", pa.array(np.arange(table.num_rows, dtype=np.int32)))


def on_rows(rows: DataFrame, keys: Sequence[str], cells: pa.Table, values: DataFrame) -> DataFrame:
    """``rows`` with what ``values`` says of their ``cell``."""
    spark = rows.sparkSession
    places = spark.createDataFrame(cells.select([*keys, "cell"]))
    known = stage(places.join(values, "cell").drop("cell"), "cell-values")
    return rows.join(known, list(keys)).drop(*keys)
