"""Registered training-data queries against their SQL."""

import os

import pytest

from oracle import connect, spark_side, sql_side
from voxloom.llm import queries

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.01")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_sql(spark, name):
    assert spark_side(queries.QUERIES[name](spark, SF_DIR)) == sql_side(connect(SF_DIR), queries.ORACLES[name])


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11)) + [11, 12, 13]
