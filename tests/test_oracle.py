"""Every query with a SQL twin agrees with it."""

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    same, why = compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name])
    assert same, why


def test_entry(spark):
    assert entry.entry(spark).count() > 0
