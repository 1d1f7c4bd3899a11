"""Every registered query against its SQL in DuckDB, on the smallest sample."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__
import oracle_queries
import registered_queries

SAMPLE = Path("/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
# Trained or iterative; test_models.py checks their properties.
WITHOUT_SQL = {"segment_customers", "ltv_scores", "churn_scores", "ml_scores", "ticket_topics"}

pytestmark = pytest.mark.skipif(not SAMPLE.exists(), reason="no sample tables")
QUERIES = registered_queries.queries()
SQL = oracle_queries.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"create view {table} as from '{SAMPLE}/{table}.parquet'")
    return connection


def normalized(rows):
    return sorted(tuple("" if v is None else str(v) for v in row) for row in rows)


def test_every_query_has_sql_or_a_reason():
    assert set(QUERIES) - set(SQL) == WITHOUT_SQL
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, str(SAMPLE))
    expected = duck.sql(SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(expected.columns)
    got = normalized(df.select(*columns).collect())
    order = [expected.columns.index(c) for c in columns]
    assert got == normalized([row[i] for i in order] for row in expected.fetchall())


def test_flagship(spark):
    assert __spark_entry__.entry(spark).count() > 0
