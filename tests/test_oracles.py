"""Every registered query against its SQL, on whole tables."""

import os

import pytest

import __spark_entry__ as entry
from oracle import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
