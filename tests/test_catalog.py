"""Registered queries against their SQL on the smallest tables.

The headline queries run by default, all of them with ALL_QUERIES=1 (or with check.py).
"""

import os

import pytest

import __spark_entry__ as contract
import bench
import check

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return check.views(SF)


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()) if os.environ.get("ALL_QUERIES") else bench.HEADLINE)
def test_query_equals_sql(spark, con, name):
    ok, note = check.compare(spark, con, SF, name)
    assert ok, note
