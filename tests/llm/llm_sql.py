"""Compare a query of the training-data operators with its SQL in DuckDB."""

import os

import duckdb

from patronlens.llm import queries

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def matches_sql(spark, name, folder):
    """Rows of the query, after they have been found equal to those of the SQL."""
    df = queries.queries()[name](spark, folder)
    duck = duckdb.connect()
    for table in TABLES:
        path = f"{folder}/{table}.parquet"
        path = f"{path}/*.parquet" if os.path.isdir(path) else path
        if table == "conversations" or os.path.exists(f"{folder}/{table}.parquet"):
            duck.sql(f"create view {table} as from '{path}'")
    expected = duck.sql(queries.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(expected.columns)
    got = df.select(*columns).collect()
    order = [expected.columns.index(c) for c in columns]
    shown = lambda rows: sorted(tuple("" if v is None else str(v) for v in row) for row in rows)
    assert shown(got) == shown([row[i] for i in order] for row in expected.fetchall())
    return got
