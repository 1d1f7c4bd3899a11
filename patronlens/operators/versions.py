"""Latest version per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_version(
    df: DataFrame,
    keys: Sequence[str],
    version: str = "_ingested_at",
    tie_break: Sequence[str] | None = None,
    wide: Sequence[str] = (),
) -> DataFrame:
    """Keep the row with the highest ``version`` for each key.

    Equal versions are decided by the remaining columns, so a recomputed task
    picks the same row. ``wide`` columns break ties last and by their 64-bit hash, which is
    computed in the scan: a caller that drops them later never sorts or shuffles
    them, yet gets the same rows. ``row_number() = 1`` lets Spark drop all but one row per
    key on the map side, so a key with very many versions does not skew the
    shuffle.
    """
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in {*keys, version, *wide}]
    if wide:
        df = df.withColumn("_wide", F.xxhash64(*wide))
    last = ["_wide"] if wide else []
    order = [F.col(c).desc_nulls_last() for c in (version, *tie_break, *last)]
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    newest = df.withColumn("_position", position).where("_position = 1")
    return newest.drop("_position", "_wide")
