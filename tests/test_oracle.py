"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from martflow.queries import ORACLES, QUERIES

from .oracle import ROOT, compare, connect

FOLDER = str(ROOT / "sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query(spark, duck, name):
    assert compare(spark, duck, FOLDER, name, QUERIES[name], ORACLES[name]) is None


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
