"""The queries that SQL can express, against it, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"
KEYS = [k for k, f in entry.queries().items() if f.__module__.startswith("tallyloom.llm") and k in entry.oracle_sql()]


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("key", KEYS)
def test_query(spark, con, key):
    same, message = compare(spark, con, entry.queries()[key], entry.oracle_sql()[key], SF_DIR)
    assert same, message
