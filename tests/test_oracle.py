"""Every registered query against the same SQL in DuckDB: names, types and exact values."""

import pytest

import __spark_entry__ as entry
from storelens.plans.registry import QUERIES
from tools.compare import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches(spark, con, name):
    assert difference(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) == ""


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["store_name", "store_revenue"] and df.count() == 5
