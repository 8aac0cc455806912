import pytest

import __spark_entry__ as entry
from sftframe.catalog.oracle import ORACLE
from sftframe.catalog.queries import QUERIES
from check import compare, sql_tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return sql_tables(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    assert compare(spark, con, SF, name) is None


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).first()["pairs"] == 34
