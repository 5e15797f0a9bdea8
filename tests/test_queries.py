"""Every query against its SQL, on the smallest tables."""

import pytest
from oracle import difference

import __spark_entry__ as driver

QUERIES, SQL = driver.queries(), driver.oracle_sql()


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, sf_dir, name):
    assert difference(spark, sf_dir, QUERIES[name], SQL[name]) is None


def test_entry(spark):
    rows = driver.entry(spark)
    assert rows.columns == ["slug", "name", "items_count"] and rows.count() > 0
