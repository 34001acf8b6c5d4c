"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"
# The queries of the corpus part are tested in a folder of their own.
QUERIES = {key: fn for key, fn in entry.queries().items() if fn.__module__.startswith("tallyloom.registry")}
ORACLES = entry.oracle_sql()
# At this scale a filter on one day may match nothing.
MAY_BE_EMPTY = {"filter_single_day", "top_shops_day", "metric_trend", "shop_trend"}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("key", QUERIES)
def test_query(spark, con, key):
    same, message = compare(spark, con, QUERIES[key], ORACLES[key], SF_DIR)
    assert same or (key in MAY_BE_EMPTY and message == "0 rows"), message
