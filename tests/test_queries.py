"""Every registered query against its DuckDB oracle at the smallest scale."""

import pytest

import __spark_entry__ as entry_points
from checks.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    ok, note, _ = compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF_DIR)
    assert ok, note


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
