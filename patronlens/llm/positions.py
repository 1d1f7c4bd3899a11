"""Positions and running totals in a total order, without sorting a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronlens.workspace import stage

_PART, _PLACE, _ROW = "_part", "_place", "_row"


def numbered(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    label: str,
    weight: Column | None = None,
    position: str = "pos",
    total: str = "total",
) -> DataFrame:
    """``df`` with the sum of the weights of the rows before each row of its group, in ascending
    order (nulls first), and with the group's whole sum; without a weight every row counts one.

    The rows are cut into ranges of the order and sorted range by range. What is summed over the
    ranges has one row per range and group, so no group is ever sorted or summed in one task.
    Equal rows are told apart by their place in the input, so that a key with very many equal
    rows spreads over several ranges. ``group`` columns must not be null. Pass a written
    table: the rows are read twice.
    """
    keys = [*group, *order]
    spread = df.withColumn(_ROW, F.monotonically_increasing_id())
    if weight is not None:
        spread = spread.withColumn("_weight", weight.cast("long"))
    ranged = spread.repartitionByRange(*keys, _ROW).sortWithinPartitions(*keys, _ROW).drop(_ROW)
    placed = ranged.withColumn(_PART, F.spark_partition_id()).withColumn(_PLACE, F.monotonically_increasing_id())
    placed = stage(placed, label)
    size = F.count(F.lit(1)) if weight is None else F.sum("_weight")
    ranges = placed.groupBy(_PART, *group).agg(size.alias("_size"), F.min(_PLACE).alias("_first"))
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select(
        _PART,
        *group,
        "_first",
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_size").over(whole).alias(total),
    )
    found = placed.join(stage(offsets, f"{label}-offsets"), [_PART, *group])
    if weight is None:
        inside = F.col(_PLACE) - F.col("_first")
    else:
        before = Window.partitionBy(_PART, *group).orderBy(_PLACE).rowsBetween(Window.unboundedPreceding, -1)
        inside = F.coalesce(F.sum("_weight").over(before), F.lit(0))
    found = found.withColumn(position, F.col("_offset") + inside)
    return found.select(*df.columns, position, total)
