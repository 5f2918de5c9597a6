"""One key with a third of all rows: the plans must split it."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from storelens.functions.keys import surrogate_key
from storelens.operators import facts
from storelens.plans.models import Star
from storelens.plans.sales import revenue_by
from storelens.sources import driver_tables
from storelens.sources.driver_tables import DriverTables

# Small limits, so that a small fixture has a partition that counts as skewed.
LIMITS = {
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
}
LINES = 600_000


@pytest.fixture
def limits(spark):
    before = {key: spark.conf.get(key, None) for key in LIMITS}
    for key, value in LIMITS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def items(spark):
    return spark.range(0, LINES, 1, 8).selectExpr(
        "case when id % 3 = 0 then 7 else pmod(xxhash64(id), 200000) end as order_id",
        "cast(id as int) as item_id",
        "case when id % 3 = 1 then 5 else pmod(xxhash64(id, 1), 1000) end as product_id",
        "cast(pmod(xxhash64(id, 2), 50) as int) as quantity",
        "cast(pmod(xxhash64(id, 3), 5000) as decimal(10,2)) as list_price",
        "cast(0 as decimal(4,2)) as discount",
        "cast(pmod(xxhash64(id, 3), 5000) as decimal(18,2)) as line_total",
    )


@pytest.fixture
def fact(items):
    return items.withColumn("dim_product_sk", surrogate_key("product_id"))


@pytest.fixture
def products(spark):
    return spark.range(1000).select(
        surrogate_key("id").alias("dim_product_sk"), (F.col("id") % 5).alias("brand_name")
    )


def test_hot_order_and_hot_month_are_split_in_the_fact_build(spark, limits, items):
    orders = spark.range(200_000).selectExpr(
        "id as order_id", "id as customer_id", "4S as order_status",
        "'Completed' as order_status_label", "date '2018-01-01' as order_date",
        "date '2018-01-08' as required_date", "date '2018-01-02' as shipped_date",
        "true as is_shipped", "1 as store_id", "1L as staff_id",
    )
    built = facts.fct_sales(items, orders, by_month=True)
    plan = plan_of(built.agg(F.max("sales_pk"), F.sum("line_total"), F.count("dim_product_sk")))
    assert "SortMergeJoin(skew=true)" in plan
    assert len(re.findall(r"AQEShuffleRead .*skewed", plan)) >= 2
    assert facts.fct_sales(items, orders).count() == LINES


def test_hot_product_is_split_for_distinct_orders(limits, fact, products):
    counted = (
        fact.join(products, "dim_product_sk")
        .groupBy("brand_name")
        .agg(F.countDistinct("order_id"), F.sum("line_total"))
    )
    assert "SortMergeJoin(skew=true)" in plan_of(counted)


def test_hot_value_is_split_in_a_ranking(spark, limits):
    from storelens.operators.ranking import dense_rank_desc

    groups = spark.range(0, LINES, 1, 8).selectExpr(
        "id as name", "case when id % 3 = 0 then 7 else pmod(xxhash64(id), 50000) end as revenue"
    )
    ranked = dense_rank_desc(groups.repartition(8), "revenue", "place")
    plan = plan_of(ranked.agg(F.max("place"), F.max("name"), F.sum("revenue")))
    assert "SortMergeJoin(skew=true)" in plan
    assert ranked.count() == LINES


def test_hot_product_is_one_row_before_the_join(limits, fact, products):
    plan = plan_of(revenue_by(fact, products, "dim_product_sk", ["brand_name"]))
    assert "skew" not in plan
    assert plan.count("partial_sum(") >= 2


def lines_of(spark, folder, rows):
    """A folder with a lineitem table: order, line number, part, supplier."""
    lines = spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long")
    lines = lines.selectExpr("*", "timestamp'2018-01-01' as l_shipdate", "1d as l_extendedprice")
    lines.write.parquet(f"{folder}/lineitem.parquet")
    return DriverTables(spark, str(folder))


@pytest.mark.parametrize("at_once", [5, 10_000])
def test_lines_are_numbered_alike_in_one_group_or_in_pieces(spark, tmp_path, monkeypatch, at_once):
    monkeypatch.setattr(driver_tables, "LINES_AT_ONCE", at_once)
    rows = [(order, i % 3, part * 4_000, i) for order in (1, 2) for i in range(4) for part in range(order * 2)]
    rows += [(3, None, 20_000, 1), (3, None, 1, 1), (3, 1, 1, 1), (None, 1, 1, 1), (None, 1, 2, 1), (None, 2, 1, 1)]
    numbered = lines_of(spark, tmp_path, rows)._numbered_lines()
    got = sorted(tuple(r) for r in numbered.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "item_id").collect() if r[0] in (1, 2))
    places = {o: 0 for o in (1, 2)}
    want = []
    for row in sorted(r for r in rows if r[0] in (1, 2)):
        places[row[0]] += 1
        want.append((*row, places[row[0]]))
    assert got == want
    # without an order or a line number, a place is counted within the piece
    odd = numbered.where("l_orderkey is null or l_orderkey = 3").select("l_orderkey", "l_linenumber", "l_partkey", "item_id")
    assert set(map(tuple, odd.collect())) == {
        (3, None, 20_000, 1), (3, None, 1, 1), (3, 1, 1, 3),
        (None, 1, 1, 1), (None, 1, 2, 2), (None, 2, 1, 1),
    }


def test_small_orders_are_not_grouped_by_pieces(spark, tmp_path):
    numbered = lines_of(spark, tmp_path, [(o, i, i, 1) for o in range(50) for i in range(4)])._numbered_lines()
    plan = plan_of(numbered.agg(F.max("item_id")))
    assert "sum(size" not in plan.split("== Initial Plan ==")[0]


def test_orders_are_shuffled_before_they_are_counted(spark, tmp_path):
    numbered = lines_of(spark, tmp_path, [(1, 1, 1, 1)])._numbered_lines().agg(F.max("item_id"))
    plan = numbered._jdf.queryExecution().executedPlan().toString().splitlines()
    below = [after for line, after in zip(plan, plan[1:]) if re.search(r"keys=\[l_orderkey#\d+L\], functions=\[partial_count", line)]
    assert below
    assert all("Exchange hashpartitioning(l_orderkey" in line for line in below)


@pytest.mark.parametrize("buckets", [1, 3, 1 << 18])
def test_large_orders_are_found_among_others_of_their_bucket(spark, tmp_path, monkeypatch, buckets):
    monkeypatch.setattr(driver_tables, "LINES_AT_ONCE", 5)
    monkeypatch.setattr(driver_tables, "ORDER_BUCKETS", buckets)
    sizes = {-3: 6, 1: 5, 2: 7, 3: 1, 4: 4, None: 9}
    sources = lines_of(spark, tmp_path, [(o, i, i, 1) for o, size in sizes.items() for i in range(size)])
    assert sorted(r[0] for r in sources._large_orders().collect()) == [-3, 2]


def test_a_snapshot_date_is_spread_over_tasks(spark, limits):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    stocks = spark.range(0, 5_000, 1, 2).selectExpr(
        "cast(id % 5 as int) as store_id", "id as product_id", "1 as quantity", "date '2018-03-01' as snapshot_date"
    )
    products = spark.range(5_000).selectExpr("id as product_id", "cast(2 as decimal(10,2)) as list_price")
    try:
        built = facts.fct_inventory_history(stocks, products, by_snapshot=True)
        tasks = built.groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert built.columns == facts.fct_inventory_history(stocks, products).columns
    assert sum(r["count"] for r in tasks) == 5_000
    assert max(r["count"] for r in tasks) < 2_500


def shop_of(spark, folder, rows):
    """`lines_of` with what the sales fact needs besides."""
    lines_of(spark, folder / "bare", rows).read("lineitem").selectExpr(
        "*", "l_suppkey + 0d as l_quantity", "0.1d as l_discount"
    ).write.parquet(f"{folder}/lineitem.parquet")
    tables = {
        "part": spark.range(40).selectExpr("id * 4000 as p_partkey", "cast(id as double) as p_retailprice"),
        "orders": spark.range(60).selectExpr(
            "id as o_orderkey", "id as o_custkey", "if(id % 2 = 0, 'F', 'O') as o_orderstatus",
            "cast(date_add(date '1995-01-31', cast(id as int)) as timestamp) as o_orderdate",
        ),
        "supplier": spark.range(4).selectExpr("id as s_suppkey", "cast(id % 2 as int) as s_nationkey"),
        "nation": spark.range(2).selectExpr("cast(id as int) as n_nationkey", "cast(id as int) as n_regionkey"),
    }
    for name, table in tables.items():
        table.write.parquet(f"{folder}/{name}.parquet")
    return DriverTables(spark, str(folder))


@pytest.mark.parametrize("at_once", [5, 10_000])
def test_order_items_in_parts_are_those_with_an_order(spark, tmp_path, monkeypatch, at_once):
    monkeypatch.setattr(driver_tables, "LINES_AT_ONCE", at_once)
    rows = [(order, i % 3, part * 4_000, i) for order in (1, 2, 59) for i in range(3) for part in range(order % 4 + 1)]
    rows += [(3, None, 20_000, 1), (3, None, 4_000, 1), (3, 1, 4_000, 1), (None, 1, 4_000, 1), (99, 1, 4_000, 1)]
    sources = shop_of(spark, tmp_path, rows)
    small, large = sources.latest_in_parts("order_items")
    whole = sources.latest("order_items")
    assert small.schema == large.schema == whole.schema
    assert bool(large.count()) == (at_once == 5)
    assert sorted(map(repr, small.union(large).collect())) == sorted(map(repr, whole.where("order_id is not null").collect()))
    star = Star(sources)
    built = star.laid_out("fct_sales").drop("order_month")
    assert built.schema == star("fct_sales").schema
    assert sorted(map(repr, built.collect())) == sorted(map(repr, star("fct_sales").collect()))


def test_lines_are_shuffled_once_by_order_and_once_by_month(spark, limits, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")  # for parts and staff
    rows = [(o, i, i * 4_000, 1) for o in range(60) for i in range(4)]
    fact = Star(shop_of(spark, tmp_path, rows)).laid_out("fct_sales")
    shuffles = re.findall(r"Exchange (hashpartitioning\(\w+)#", plan_of(fact))
    assert shuffles.count("hashpartitioning(order_month") == 1
    assert shuffles.count("hashpartitioning(l_orderkey") == 1
    assert shuffles.count("hashpartitioning(order_id") == 1  # the orders


def test_orders_are_not_shuffled_for_their_staff(spark, tmp_path):
    orders = shop_of(spark, tmp_path, [(1, 1, 0, 1)]).orders()
    assert "Exchange hashpartitioning" not in plan_of(orders)
    assert orders.count() == 60
