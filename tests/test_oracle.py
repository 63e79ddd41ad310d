"""Every registered query against its SQL on the given tables, values and all."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from accountwatch.catalog.oracle import ORACLE
from accountwatch.catalog.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    """Text operators that SQL cannot express are compared with brute force in their own tests."""
    assert set(QUERIES) == set(ORACLE)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got = contract.queries()[name](spark, SF_DIR)
    want = duck.sql(contract.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    rows = _rows(want.columns, want.fetchall())
    assert _rows(got.columns, [tuple(r) for r in got.collect()]) == rows
    assert rows, "a comparison of nothing proves nothing"


def test_entry(spark):
    assert contract.entry(spark).count() == 47
