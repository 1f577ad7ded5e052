"""Every catalogue query against its SQL, on whole tables."""

import pytest

import __spark_entry__ as driver
from quayflow.plans.queries import ORACLE_SQL, QUERIES
from compare import difference, duckdb_rows, spark_rows


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE_SQL.keys()
    assert driver.queries().keys() >= driver.oracle_sql().keys() >= ORACLE_SQL.keys()


@pytest.mark.parametrize("name", driver.oracle_sql())
def test_query_equals_sql(spark, sf_dir, name):
    ours = spark_rows(driver.queries()[name](spark, sf_dir))
    theirs = duckdb_rows(driver.oracle_sql()[name], sf_dir)
    assert sum(theirs[1].values()) > 0
    assert difference(ours, theirs) is None


def test_entry(spark, sf_dir):
    assert driver.entry(spark).count() > 0
