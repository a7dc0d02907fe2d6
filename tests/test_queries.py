"""Every registered query against its SQL counterpart on the shared tables."""

import os

import pytest

import __spark_entry__ as entry
from check import compare, connect, types_of
from ledgerloom.checks import all_oracles, all_queries

FOLDER = os.environ.get("CHECK_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    diff = compare(df, con, ORACLES[name])
    # On the smallest tables a narrow query may rightly be empty on both sides.
    assert diff in (None, "EMPTY result"), diff
    assert types_of(df, con, ORACLES[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
