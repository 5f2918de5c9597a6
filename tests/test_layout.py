"""Stored facts: rows lie by store and product, and key lists skip row groups."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from conftest import Shop, rows
from storelens.plans import filters as plan_filters
from storelens.plans import inventory, performance, sales
from storelens.plans.filters import Filters
from storelens.plans.layout import PARTITION_BY, laid_out, stored_order
from storelens.plans.models import Star, StoredStar, model_path
from storelens.plans.warehouse import build_warehouse, write_model
from storelens.sources import versions

ROWS = 120_000


def scanned(df):
    """Rows that the scan gave out, after row groups and pages were skipped."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    leaves = plan.collectLeaves()
    leaf = leaves.apply(0)
    return leaf.metrics().apply("numOutputRows").value()


@pytest.fixture(scope="module")
def fact(spark, tmp_path_factory):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = str(tmp_path_factory.mktemp("fact") / "rows")
    df = spark.range(ROWS, numPartitions=2).select(
        F.lit("2018-03-01").cast("date").alias("order_month"),
        F.md5((F.col("id") % 7).cast("string")).alias("dim_store_sk"),
        F.md5((F.col("id") % 1009).cast("string")).alias("dim_product_sk"),
        F.md5((F.col("id") % 31).cast("string")).alias("dim_staff_sk"),
        "id",
    )
    conf.set("parquet.block.size", str(1 << 18))
    try:
        laid_out(df, "fct_sales").parquet(path)
    finally:
        conf.unset("parquet.block.size")
    return spark.read.parquet(path)


def key(value):
    return F.md5(F.lit(str(value)))


def test_models_are_stored_in_zstd(spark, fact, tmp_path):
    laid_out(spark.range(3), "stg_orders").parquet(f"{tmp_path}/rows")
    for stored in (fact, spark.read.parquet(f"{tmp_path}/rows")):
        assert all(".zstd." in file for file in stored.inputFiles())


def test_a_store_skips_row_groups(fact):
    chosen = fact.where(F.col("dim_store_sk") == key(3))
    assert scanned(chosen) < ROWS / 3
    assert chosen.count() == sum(1 for i in range(ROWS) if i % 7 == 3)


def test_a_list_of_products_skips_pages(fact):
    values = list(fact.sparkSession.range(1).select(key(5).alias("a"), key(6).alias("b")).first())
    chosen = fact.where(F.col("dim_product_sk").isin(*values))
    assert scanned(chosen) < ROWS / 2
    assert chosen.count() == sum(1 for i in range(ROWS) if i % 1009 in (5, 6))


def test_a_staff_member_who_is_not_there_reads_nothing(fact):
    assert scanned(fact.where(F.col("dim_staff_sk") == key("nobody"))) == 0


FILTERS = [
    Filters(stores=("North",)), Filters(brands=("Trek",), categories=("Road", "Kids")), Filters(staff=("Ann Boss",)),
    Filters(stores=("South",), store_scope="staff"), Filters(brands=("None such",)), Filters(stores=("North",), brands=("Surly",)),
]


@pytest.mark.parametrize("filters", FILTERS)
def test_resolved_filters_give_the_same(star, filters):
    resolved = filters.resolved(star)
    assert len(resolved.keys) >= 1
    for query in (sales.sales_kpis, performance.revenue_by_brand, inventory.inventory_kpis, inventory.store_inventory_share):
        assert rows(query(star, resolved)) == rows(query(star, filters))
    plan = resolved.sales(star)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" not in plan


def test_too_many_keys_stay_a_join(star):
    filters = Filters(categories=("Road", "Kids"))
    assert filters.resolved(star, most=1).keys == ()
    assert len(filters.resolved(star, most=2).keys[0][2]) == 2


@pytest.mark.parametrize("most, hint", [(2, True), (1, False)])
def test_keys_beyond_a_list_are_broadcast_up_to_a_limit(star, monkeypatch, most, hint):
    monkeypatch.setattr(plan_filters, "BROADCAST_KEYS", most)
    filters = Filters(categories=("Road", "Kids"))
    resolved = filters.resolved(star, most=1)
    fact = resolved.sales(star)
    assert ("strategy=broadcast" in fact._jdf.queryExecution().analyzed().toString()) == hint
    assert rows(sales.sales_kpis(star, resolved)) == rows(sales.sales_kpis(star, filters))
    # with other names nothing that was looked up holds
    assert "strategy=broadcast" not in resolved.without_entities().sales(star)._jdf.queryExecution().analyzed().toString()


def test_lists_reach_the_scan_of_a_stored_fact(spark, tmp_path):
    stored = build_warehouse(Shop(spark), str(tmp_path), check=False)
    assert isinstance(stored, StoredStar) and isinstance(stored, Star)
    fact = Filters(stores=("North",)).resolved(stored).sales(stored)
    plan = fact._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "dim_store_sk" in scan.split("PushedFilters: [")[1].split("]")[0]


@pytest.mark.parametrize("name", ["fct_sales", "fct_inventory_history"])
def test_facts_are_sorted_once_before_the_other_hashes(star, name):
    plan = star.laid_out(name)._jdf.queryExecution().executedPlan().toString()
    above, *below = plan.split(f"Sort [{stored_order(name)[0]}#")
    assert len(below) == 1
    hashes = [len(set(re.findall(r" AS (\w+_[ps]k)#", part))) for part in (above, below[0])]
    assert hashes == ([4, 2] if name == "fct_sales" else [2, 2])


@pytest.mark.parametrize("name", ["fct_sales", "fct_inventory_history"])
def test_facts_are_stored_in_order(spark, tmp_path, name):
    days = [dt.date(2018, 1 + i % 3, 1 + i % 5) for i in range(60)]
    star = Star(Shop(
        spark,
        orders=[(i, 1, 4, day, None, None, 1 + i % 2, 1 + i % 3) for i, day in enumerate(days)],
        order_items=[(i, j, 1 + (i + j) % 3, 1, 1, 0) for i in range(60) for j in range(4)],
        stocks=[(store, 1 + i % 3, i, dt.date(2018, 3, 1 + i // 3)) for i in range(9) for store in (1, 2)],
    ))
    by, *keys = stored_order(name)
    version = write_model(star.laid_out(name), str(tmp_path), name)
    stored = spark.read.parquet(versions.version_path(model_path(str(tmp_path), name), version))
    wanted = star(name)
    assert sorted(map(repr, stored.select(*wanted.columns).collect())) == sorted(map(repr, wanted.collect()))
    files = {}
    for file, *row in stored.select(F.input_file_name(), *keys).collect():
        files.setdefault(file, []).append(row)
    assert all(f"{by}=" in file for file in files) and PARTITION_BY[name] == by
    assert max(map(len, files.values())) > 3
    assert all(found == sorted(found) for found in files.values())
