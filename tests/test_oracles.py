"""Every registered query runs, and equals its SQL twin where it has one."""

import pytest
from oracle import compare, connect

from riskloom.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
# takes over a minute; run by tests/oracle.py
SLOW = {"p9_feature_selection"}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, con, name):
    assert compare(QUERIES[name](spark, FOLDER), con, ORACLES[name])[:5] == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - SLOW))
def test_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
