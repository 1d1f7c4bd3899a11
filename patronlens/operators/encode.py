"""Feature transforms: log, one-hot, clip."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.functions.numbers import require_columns, to_number

# Columns transformed by default.
MONETARY_COLUMNS = ("total_spend_365d_usd", "total_spend_usd")
CATEGORICAL_COLUMNS = ("acquisition_channel", "segment_label")


def with_log1p(df: DataFrame, columns: Sequence[str] = MONETARY_COLUMNS) -> DataFrame:
    """Append ``<column>_log1p`` for each column that is present."""
    return df.withColumns(
        {f"{c}_log1p": F.log1p(to_number(F.col(c))) for c in columns if c in df.columns}
    )


#: Most values of a category that become columns of their own.
MAX_CATEGORIES = 1000


def categories_of(df: DataFrame, column: str) -> list[str]:
    """Sorted distinct values, each of which becomes a column; an error if there are too many."""
    found = df.select(F.col(column).cast("string").alias("v")).where("v is not null").distinct()
    values = sorted(row.v for row in found.limit(MAX_CATEGORIES + 1).collect())
    if len(values) > MAX_CATEGORIES:
        raise ValueError(f"{column} has more than {MAX_CATEGORIES} values: name the categories to encode")
    return values


def one_hot(
    df: DataFrame,
    columns: Sequence[str] = CATEGORICAL_COLUMNS,
    ignore_missing: bool = True,
    drop_first: bool = False,
    categories: dict[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Replace each column by 0/1 columns ``<column>_<value>``, in value order, after
    the other columns. A null is 0 everywhere. ``categories`` saves the pass that
    looks up the values, which may be ``MAX_CATEGORIES`` at most. Models count cells instead
    (``models.grid``)."""
    if not ignore_missing:
        require_columns(df, columns)
    present = [c for c in columns if c in df.columns]
    indicators = []
    for column in present:
        values = (categories or {}).get(column) or categories_of(df, column)
        for value in list(values)[1 if drop_first else 0 :]:
            is_value = F.col(column).cast("string").eqNullSafe(F.lit(value))
            indicators.append(is_value.cast("tinyint").alias(f"{column}_{value}"))
    return df.select(*[F.col(c) for c in df.columns if c not in present], *indicators)


def clip(
    df: DataFrame, column: str, lower: float | None = None, upper: float | None = None
) -> DataFrame:
    """Limit ``column`` to [lower, upper]; ``None`` leaves a side open."""
    require_columns(df, [column])
    if lower is None and upper is None:
        raise ValueError("give a lower or an upper bound")
    if None not in (lower, upper) and lower > upper:
        raise ValueError(f"lower bound {lower} lies above upper bound {upper}")
    number = to_number(F.col(column))
    limited = number
    if lower is not None:
        limited = F.greatest(limited, F.lit(float(lower)))
    if upper is not None:
        limited = F.least(limited, F.lit(float(upper)))
    return df.withColumn(column, F.when(number.isNotNull(), limited))
