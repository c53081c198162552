"""Every registered query against its oracle at the smallest scale."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry_points

FOLDER = "/root/testdata/sf0.001"
QUERIES = {k: v for k, v in entry_points.queries().items() if k not in entry_points.TEXT_QUERIES}
ORACLE = {k: v for k, v in entry_points.oracle_sql().items() if k not in entry_points.TEXT_QUERIES}


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_runs(spark):
    rows = entry_points.entry(spark).collect()
    assert len(rows) == 7 and rows[0]["date"] > rows[-1]["date"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    assert compare(spark, duck, FOLDER, QUERIES[name], ORACLE[name]) == ""
