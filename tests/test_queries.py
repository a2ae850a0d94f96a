"""Every registered query beside its SQL restatement."""

import pytest
from oracle import compare, connect

import __spark_entry__ as driver

QUERIES, SQL = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(name, spark, sf_dir, con):
    rows, only_spark, only_sql = compare(QUERIES[name](spark, sf_dir), con, SQL[name])
    assert not only_spark and not only_sql
    assert rows > 0 or con.execute(SQL[name]).fetchall() == []


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert driver.entry(spark).count() > 0
