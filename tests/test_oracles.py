"""Every registered query against its SQL on the smallest test data."""

import os

import pytest
from compare import connect, differences
from places import TESTDATA

import __spark_entry__ as entry
from ledgerloom.plans.oracles import ORACLES
from ledgerloom.plans.registry import QUERIES

FOLDER = os.path.join(TESTDATA, os.environ.get("TEST_SF", "sf0.001"))
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert differences(entry.queries()[name](spark, FOLDER), con, entry.oracle_sql()[name]) == []


def test_entry(spark):
    assert 0 < entry.entry(spark).count() <= 10
