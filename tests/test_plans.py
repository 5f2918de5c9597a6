"""What the physical plans must and must not contain."""

import re

import pytest

from conftest import plan_of
from storelens.plans import performance, sales
from storelens.plans.registry import DASHBOARD, QUERIES, star_of

SF = "/root/testdata/sf0.001"
# The only windows without a partition there: over the distinct part types of the test inputs, and
# over the value buckets of a ranking, which the value's type bounds. Snapshots are aggregated rows.
BOUNDED_KEYS = {"p_type", "_bucket"}
BOUNDED_WINDOWS = {"snapshot_change"}


@pytest.fixture(scope="module")
def plans(spark):
    """The plans before a run."""
    return {name: planned(query(spark, SF)) for name, query in DASHBOARD.items()}


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_and_no_pair_joins(plans):
    for name, plan in plans.items():
        for banned in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert banned not in plan, (name, banned)


def test_windows_are_over_bounded_rows(plans):
    for name, plan in plans.items():
        unpartitioned = re.findall(r"windowspecdefinition\((\w+)#\d+L? (?:ASC|DESC)", plan)
        loose = set(unpartitioned) - BOUNDED_KEYS
        if name not in BOUNDED_WINDOWS:
            assert not loose, (name, loose)


def test_totals_reuse_the_shuffle(spark):
    for name in (
        "order_status_distribution", "category_revenue_share", "inventory_value_by_brand",
        "store_inventory_share", "revenue_share",
    ):
        assert "ReusedExchange" in plan_of(DASHBOARD[name](spark, SF)), name


def test_brands_are_aggregated_once_for_rows_ranks_and_total(spark):
    assert plan_of(QUERIES["revenue_by_brand"](spark, SF)).count("FileScan parquet [l_orderkey") == 1


def test_scans_read_only_what_they_need(plans):
    kpis = plans["sales_kpis"]
    schema = re.findall(r"ReadSchema: struct<([^>]*)>", kpis)
    lineitem = next(s for s in schema if "l_orderkey" in s)
    assert "l_suppkey" not in lineitem and "l_shipdate" not in lineitem
    assert "row_number" not in kpis


def test_fact_is_summed_before_it_meets_the_dimension(spark):
    star = star_of(spark, SF)
    for query, key in (
        (sales.revenue_by_store, "dim_store_sk"),
        (sales.revenue_by_category, "dim_product_sk"),
        (performance.top_customers, "dim_customer_sk"),
    ):
        plan = planned(query(star))
        join = next(
            i for i, line in enumerate(plan.splitlines()) if re.search(rf"Join \[{key}", line)
        )
        assert any(
            "HashAggregate(keys=[" + key in line for line in plan.splitlines()[join:]
        ), key


def test_every_query_has_an_oracle():
    from oracle.queries import oracle_sql

    assert set(QUERIES) == set(oracle_sql())
