"""Every registered query with check SQL gives the same rows in DuckDB."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
SQL = contract.oracle_sql()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def _plain(value):
    return round(float(value), 8) if isinstance(value, float) else value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(repr(_plain(r[i])) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, name):
    got = contract.queries()[name](spark, SF_DIR)
    cursor = duck.execute(SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(got.columns) == sorted(columns)
    expected = _rows(columns, cursor.fetchall())
    assert _rows(got.columns, got.collect()) == expected
    assert expected


def test_every_check_belongs_to_a_query():
    assert set(SQL) <= set(contract.queries())


def test_entry_runs(spark):
    assert contract.entry(spark).count() == 4
