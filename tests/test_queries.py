"""Registered queries against their SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from catalog import registry
from oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
# Each fits 300 trees; ORACLE_ALL=1 runs both.
SLOW = {"m02_forest_forecast"}
SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
@pytest.mark.parametrize("name", [n for n in registry.SQL if n not in SLOW or os.environ.get("ORACLE_ALL")])
def test_equals_sql(spark, con, name):
    assert compare(spark, con, FOLDER, name, QUERIES[name], SQL[name]) == ""


def test_registry_is_consistent():
    assert SLOW <= set(SQL) <= set(QUERIES)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
