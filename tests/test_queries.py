"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import datetime
import math
import os

import duckdb
import pytest

import __spark_entry__ as driver

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return f"{float(value) + 0.0:.6f}"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_agrees_with_sql(spark, duck, name):
    df = driver.queries()[name](spark, SF_DIR)
    relation = duck.sql(driver.oracle_sql()[name])
    assert sorted(df.columns) == sorted(relation.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(relation.columns, relation.fetchall())


@pytest.mark.parametrize("name", sorted(set(driver.queries()) - set(driver.oracle_sql())))
def test_query_without_sql_gives_rows(spark, name):
    assert driver.queries()[name](spark, SF_DIR).count() > 0


def test_flagship(spark):
    assert driver.entry(spark).count() > 0
