"""Raw tables: Parquet with declared schemas, or an external database over JDBC."""

from __future__ import annotations

from dataclasses import dataclass, fields
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.operators.orphans import with_parent_flag
from patronlens.schema import raw_schema


@dataclass(frozen=True)
class RawTables:
    """The six raw tables."""

    customers: DataFrame
    orders: DataFrame
    order_items: DataFrame
    events: DataFrame
    campaigns: DataFrame
    tickets: DataFrame

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(f.name, getattr(self, f.name)) for f in fields(self)]


def read_raw(spark: SparkSession, root: str) -> RawTables:
    """Scan ``<root>/<table>`` for each raw table; schemas are never inferred."""
    return RawTables(
        **{
            f.name: spark.read.schema(raw_schema(f.name)).parquet(f"{root}/{f.name}")
            for f in fields(RawTables)
        }
    )


def read_database(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower: date | int,
    upper: date | int,
    partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Read-only scan of a database table, split into ``partitions`` range queries."""
    if partitions < 1:
        raise ValueError("a database scan needs at least one partition")
    reader = spark.read.format("jdbc").options(
        url=url,
        dbtable=table,
        partitionColumn=partition_column,
        lowerBound=str(lower),
        upperBound=str(upper),
        numPartitions=str(partitions),
        **(properties or {}),
    )
    return reader.load()


def require_parent(parent: DataFrame, key: str) -> None:
    """An empty parent table is an error for every load that refers to it."""
    if parent.where(F.col(key).isNotNull()).isEmpty():
        raise RuntimeError(f"the parent table has no {key}: load it first")


def with_known_parent(child: DataFrame, child_id: str, key: str, parent: DataFrame) -> DataFrame:
    """Child rows whose parent exists. The parent keys stay distributed."""
    require_parent(parent, key)
    flagged = with_parent_flag(child, F.col(child_id), key, parent, key)
    return flagged.where("has_parent").drop("has_parent")
