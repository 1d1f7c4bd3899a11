"""Exact stratified train/validation split for any number of strata."""

from __future__ import annotations

import logging
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronlens.operators.tiles import at_or_after, rows_at_ranks
from patronlens.workspace import stage

log = logging.getLogger(__name__)

VALIDATION_FRACTION = 0.20
SLOT_ROWS = 50_000  # rows that share one hash slot, over all strata
_HASH_BITS = 60


def hash_order(row_id: Column) -> Column:
    """A pseudo-random but repeatable 60-bit order of the ids."""
    return F.conv(F.substring(F.md5(row_id.cast("binary")), 1, 15), 16, 10).cast("long")


def validation_rows(rows: int, fraction: float = VALIDATION_FRACTION) -> int:
    """Rows held out of ``rows``: the fraction, rounded up."""
    share = Fraction(str(fraction))
    return -(-rows * share.numerator // share.denominator)


def _quotas(sizes: DataFrame, rows: int, fraction: float) -> DataFrame:
    """``stratum, quota``: the whole part of each stratum's share, and one more for the strata
    with the largest remainders until ``validation_rows(rows)`` are reached. The last stratum to
    get one more is found by counting, so no task sees all strata."""
    share = Fraction(str(fraction))
    product = F.col("n") * share.numerator
    parts = stage(
        sizes.select(
            "stratum",
            F.expr(f"n * {share.numerator} div {share.denominator}").alias("whole"),
            (product % share.denominator).alias("rest"),
        ),
        "split-quotas",
    )
    extra = validation_rows(rows, fraction) - parts.agg(F.sum("whole")).first()[0]
    order = -F.col("rest")
    cuts = rows_at_ranks(parts, "stratum", {"rest": order}, lambda _, n: [extra] if extra < n else [])
    late = F.lit(False)
    for cut in cuts["rest"]:
        late = at_or_after(order, "stratum", cut)
    return parts.select("stratum", (F.col("whole") + F.when(late, 0).otherwise(1)).alias("quota"))


def _last_held_out(rows: DataFrame, quotas: DataFrame, total: int) -> DataFrame:
    """``stratum, last_order, last_id``: the last held-out row of each stratum that has one.

    Rows are counted per stratum and hash slot; only the slot in which the quota of a stratum is
    reached is ranked row by row, so a stratum of any size costs one slot in one task.
    """
    slots = 1 << max(0, (total // SLOT_ROWS).bit_length())
    shift = _HASH_BITS - (slots.bit_length() - 1)
    slotted = rows.withColumn("slot", F.shiftright("order", shift))
    upto = Window.partitionBy("stratum").orderBy("slot")
    counted = slotted.groupBy("stratum", "slot").agg(F.count(F.lit(1)).alias("n"))
    reached = counted.withColumn("upto", F.sum("n").over(upto)).join(quotas, "stratum")
    cut = reached.where(
        (F.col("quota") > 0) & (F.col("upto") >= F.col("quota")) & (F.col("upto") - F.col("n") < F.col("quota"))
    ).select("stratum", "slot", (F.col("quota") - F.col("upto") + F.col("n")).alias("position"))
    place = F.row_number().over(Window.partitionBy("stratum").orderBy("order", "id"))
    ranked = slotted.join(cut, ["stratum", "slot"]).withColumn("place", place)
    return ranked.where("place = position").select(
        "stratum", F.col("order").alias("last_order"), F.col("id").alias("last_id")
    )


def with_split(
    df: DataFrame, row_id: str, stratum: str, fraction: float = VALIDATION_FRACTION
) -> DataFrame:
    """Add the boolean ``is_validation``.

    ``validation_rows`` rows are held out in total, those with the lowest hashes of each
    stratum; strata differ from their exact share by less than one row. If a stratum has
    a single row, or fewer rows are held out or trained on than there are strata, the
    table is split as one and a warning says so. ``df`` is read several times: pass a written
    table. A null stratum is the empty text.
    """
    label = F.coalesce(F.col(stratum).cast("string"), F.lit(""))
    rows = df.select(
        label.alias("stratum"), F.col(row_id).cast("string").alias("id"), hash_order(F.col(row_id)).alias("order")
    )
    sizes = stage(rows.groupBy("stratum").agg(F.count(F.lit(1)).alias("n")), "split-sizes")
    strata, total, least = sizes.agg(F.count(F.lit(1)), F.sum("n"), F.min("n")).first()
    if not strata:
        return df.withColumn("is_validation", F.lit(False))
    held_out = validation_rows(total, fraction)
    if least < 2 or min(held_out, total - held_out) < strata:
        log.warning(
            "%d strata of %d rows or more cannot be split by %r; splitting %d rows as one",
            strata, least, stratum, total,
        )
        order = hash_order(F.col(row_id))
        cuts = rows_at_ranks(
            df, row_id, {"all": order}, lambda _, n: [held_out] if held_out < n else []
        )
        trained = F.lit(False)
        for cut in cuts["all"]:
            trained = at_or_after(order, row_id, cut)
        return df.withColumn("is_validation", ~trained)
    last = _last_held_out(rows, _quotas(sizes, total, fraction), total)
    order, ident = hash_order(F.col(row_id)), F.col(row_id).cast("string")
    early = (order < F.col("last_order")) | ((order == F.col("last_order")) & (ident <= F.col("last_id")))
    joined = df.join(last.withColumnRenamed("stratum", "_stratum"), label == F.col("_stratum"), "left")
    return joined.withColumn("is_validation", F.coalesce(early, F.lit(False))).select(
        *df.columns, "is_validation"
    )
