"""Every registered query with SQL gives the same rows as DuckDB."""

import pytest

import __spark_entry__ as entry
from compare import compare, duck

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_names_match():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    ok, note = compare(spark, con, SF, QUERIES[name], ORACLES[name])
    assert ok, note


def test_entry(spark):
    assert entry.entry(spark).count() == 20
