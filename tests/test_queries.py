"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_point
from lakemart.queries.registry import ORACLES as SQL
from lakemart.queries.registry import QUERIES
from tests.oracle import BASE, connect, differences

FOLDER = f"{BASE}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    extra, lacking, count = differences(QUERIES[name](spark, FOLDER), con, SQL[name])
    assert (extra, lacking) == ([], [])
    assert count > 0


def test_flagship(spark):
    assert entry_point.entry(spark).count() > 0
