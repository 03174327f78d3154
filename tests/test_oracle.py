"""Every named query against its SQL on the same tables, in DuckDB."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as driver
from ledgerspark.registry import queries as _queries
from ledgerspark.registry.queries import ALIASES
from ledgerspark.sources.testdata import TABLES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return connection


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return "null"
    return repr(round(value, 6) + 0.0) if isinstance(value, float) else str(value)


def test_every_query_has_sql():
    assert set(_queries.queries()) <= set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", [n for n in _queries.queries() if n not in ALIASES])
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    got = sorted([plain(row[c]) for c in sorted(df.columns)] for row in df.collect())
    result = duck.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted([plain(row[columns.index(c)]) for c in sorted(columns)] for row in result.fetchall())
    assert got == want


def test_entry(spark):
    df = driver.entry(spark)
    assert df.count() == 5 and "spend_percentage" in df.columns
