"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query_matches_sql(spark, con, name):
    ok, note, _ = compare(spark, con, SF, entry.queries()[name], SQL.get(name))
    assert ok, note


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_sql_names_are_queries():
    assert set(SQL) <= set(entry.queries())
