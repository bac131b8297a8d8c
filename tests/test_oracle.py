"""Every registered query against its SQL, with exact equality of all values."""

import pytest
from compare import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from closeworks.plans.registry import all_queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(all_queries()) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_equal(spark, con, name):
    assert compare(queries()[name](spark, SF), con, oracle_sql()[name]) == []


def test_entry(spark):
    assert entry(spark).limit(1).count() == 1
