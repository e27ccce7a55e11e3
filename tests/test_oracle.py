"""Every registered query against the same query in SQL on another engine."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry
from pulsetrail.plans.catalog import QUERIES as OWN

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, folder, name):
    assert differences(QUERIES[name](spark, folder), con, SQL[name]) is None


def test_every_sql_has_a_query():
    assert SQL.keys() <= QUERIES.keys()
    assert OWN.keys() - SQL.keys() == {"table_inventory_storage"}


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
