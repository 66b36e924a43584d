"""Every registered query against its SQL on the same tables."""

import os

import pytest

import __spark_entry__ as entry
from oracle import connect, spark_side, sql_side

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_registrations():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    columns, rows = spark_side(QUERIES[name](spark, SF_DIR))
    if name in SQL:
        want_columns, want = sql_side(con, SQL[name])
        assert columns == want_columns
        assert rows == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
