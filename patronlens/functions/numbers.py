"""Null-safe numeric helpers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that count as true.
TRUE_TEXTS = ("true", "t", "1", "yes", "y")


# What a text must look like to be a number; a cast alone would also take "1d" and "2f".
_NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)\s*$"


def to_number(column: Column) -> Column:
    """Numeric value of a column; what cannot be read as a number becomes null."""
    readable = column.try_cast("string").rlike(f"{_NUMBER}|(?i)^(true|false|nan)$")
    number = F.when(readable, column.try_cast("double"))
    return F.when(~F.isnan(number), number)


def number_or(column: Column, default: float) -> Column:
    return F.coalesce(to_number(column), F.lit(float(default)))


def is_true(df: DataFrame, name: str) -> Column:
    """Truth of a flag stored as boolean, number or text; null counts as false."""
    flag = F.col(name)
    match df.schema[name].dataType:
        case T.BooleanType():
            truth = flag
        case T.NumericType():
            truth = number_or(flag, 0) > 0  # NaN would sort above all numbers
        case _:
            bare = F.regexp_replace(flag.cast("string"), r"(?U)^\s+|\s+$", "")
            truth = F.lower(bare).isin(*TRUE_TEXTS)
    return F.coalesce(truth, F.lit(False))


def require_columns(df: DataFrame, names: Iterable[str], error: type[Exception] = KeyError) -> None:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise error(f"missing required columns: {missing}")
