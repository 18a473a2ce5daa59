"""Every registered query: rows equal to its SQL on DuckDB, or at least rows."""

import pytest
from conftest import SMALL
from oracle import differences, duck

import __spark_entry__ as driver
from marketlake.catalog import all_queries

QUERIES = all_queries()
MAY_BE_EMPTY = {"near_vectors"}


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_equals_sql(spark, con, name):
    query = QUERIES[name]
    assert differences(query.run(spark, SMALL), con, query.sql) is None


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if not q.sql])
def test_gives_rows(spark, name):
    rows = QUERIES[name].run(spark, SMALL)
    assert name in MAY_BE_EMPTY or not rows.isEmpty()


def test_driver_contract(spark):
    assert driver.queries().keys() >= QUERIES.keys()
    assert driver.oracle_sql().keys() <= driver.queries().keys()
    assert driver.entry(spark).count() > 0
