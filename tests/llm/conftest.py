import math
import os

import duckdb
import pytest

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.fixture(scope="session")
def documents(spark):
    """Make a table of documents from (doc_id, text) or longer rows."""

    def make(rows, columns="doc_id bigint, text string, lang string, source string, n_chars bigint"):
        width = len(columns.split(", "))
        full = [tuple(r) + (None,) * (width - len(r)) for r in rows]
        return spark.createDataFrame(full, columns)

    return make


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    return f"{value:.6f}" if isinstance(value, float) else str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)
