"""Every query against its SQL on the smallest tables; the others must at least return rows."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry_points

SF = "/root/testdata/sf0.001"
SQL = entry_points.oracle_sql()
QUERIES = entry_points.queries()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_returns_rows(spark, name):
    assert len(QUERIES[name](spark, SF).take(1)) == 1


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry_points.entry(spark).count() == 7
