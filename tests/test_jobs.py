import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import DAY1, DAY2, Shop, plan_of, rows
from storelens.operators.loads import latest_full_load
from storelens.operators.quality import ChecksFailed
from storelens.operators.staging import stg_products
from storelens.plans.models import LandedTables, StoredStar, model_path
from storelens.plans.warehouse import (
    BUILD_ORDER,
    build_warehouse,
    ingest,
    ingest_production,
    ingest_sales,
    landed_catalog,
)
from storelens.session import scratch_path, shared_dir
from storelens.sources import raw
from storelens.sources.jdbc import Connection, base_tables, split_options
from storelens.sources.object_store import lakehouse_root, object_store_conf
from storelens.sources.schemas import TABLES
from storelens.sources.versions import read_state
from storelens.streaming.snapshots import STOCKS, read_history, snapshot_stream


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


def land(shop, root, name, day, run):
    raw.write_snapshot(shop.latest(name), root, TABLES[name], raw.Load(day, run))


def test_snapshots_are_kept_side_by_side(spark, shop, root):
    for day, run in ((DAY1, "z"), (DAY2, "b"), (DAY2, "a"), (DAY2, "a")):
        land(shop, root, "brands", day, run)
    landed = raw.scan(spark, root, TABLES["brands"])
    found = landed.groupBy("ingestion_date", "run_id").count()
    assert sorted(rows(found)) == [(DAY1, "z", 2), (DAY2, "a", 2), (DAY2, "b", 2)]
    assert dict(landed.dtypes)["ingestion_date"] == "date"
    # by date both runs of the newest day count, by run only the one that ran last
    assert LandedTables(spark, root, by="date").latest("brands").count() == 4
    newest = LandedTables(spark, root).latest("brands")
    assert rows(newest.select("ingestion_date", "run_id").distinct()) == [(DAY2, "a")]
    history = LandedTables(spark, root).history("brands")
    assert sorted(rows(history.select("run_id").distinct())) == [("a",), ("z",)]


def test_manifest(spark, shop, root):
    load = raw.Load(DAY1, "run")
    ingest_sales(lambda t: shop.latest(t.name), root, load)
    ingest_production(lambda t: shop.latest(t.name), root, load)
    manifest = raw.read_manifest(spark, root)
    got = {r.table: r for r in manifest.collect()}
    assert set(got) == set(TABLES)
    assert got["orders"].row_count == 5 and got["stocks"].row_count == 6
    assert got["orders"].path.endswith(
        "raw/supabase/sales/orders/ingestion_date=2018-03-01/run_id=run"
    )
    assert all(r.ingestion_strategy == "full_load" and r.loaded_at for r in got.values())
    listed = rows(base_tables(landed_catalog(spark, root), "production"))
    assert listed == [("production", t) for t in ("brands", "categories", "products", "stocks")]
    assert base_tables(landed_catalog(spark, root)).count() == 9


def test_loads_at_the_same_time_do_not_meet(spark, shop, root):
    load = raw.Load(DAY1, "run")
    ingest(lambda t: shop.latest(t.name), list(TABLES.values()) , root, load)
    assert raw.read_manifest(spark, root).count() == 9


def test_drifted_types_fail_the_read_or_are_cast_on_request(spark, root):
    table = TABLES["orders"]
    path = raw.snapshot_path(root, table, raw.Load(DAY1, "r"))
    drifted = spark.sql(
        "select 1L order_id, 7.0d customer_id, 4L order_status, date '2018-01-01' order_date, "
        "date '2018-01-02' required_date, cast(null as date) shipped_date, 1L store_id, "
        "2L staff_id"
    )
    drifted.write.parquet(path)
    with pytest.raises(Exception, match="customer_id|column"):
        raw.scan(spark, root, table).collect()
    row = raw.scan_untyped(spark, root, table).first()
    assert row.customer_id == 7 and isinstance(row.customer_id, int) and row.run_id == "r"


def test_newest_load_is_a_partition_filter(spark, shop, root):
    for day in (DAY1, DAY2):
        land(shop, root, "products", day, "r")
    landed = raw.scan(spark, root, TABLES["products"])
    for newest, columns in (
        (latest_full_load(landed), ["ingestion_date"]),
        (LandedTables(spark, root).latest("products"), ["ingestion_date", "run_id"]),
    ):
        assert newest.count() == 3
        newest.collect()
        plan = newest._jdf.queryExecution().executedPlan().toString()
        scans = [x for x in plan.splitlines() if "FileScan" in x and "product_name" in x]
        filters = scans[0].split("PartitionFilters: [")[1].split("PushedFilters")[0]
        assert "= Subquery" in filters or "= ReusedSubquery" in filters
        assert all(column in filters for column in columns)


def test_build_and_rebuild(spark, shop, root):
    stored = build_warehouse(shop, root, check=False)
    stored = build_warehouse(shop, root, check=False)
    counts = {name: stored(name).count() for name in BUILD_ORDER}
    assert counts["fct_sales"] == 6 and counts["stg_stocks"] == 6
    assert counts["fct_inventory_history"] == 8 and counts["dim_date"] == 7306
    months = stored("fct_sales").select("order_month").distinct()
    assert sorted(rows(months)) == [
        (dt.date(2016, 2, 1),), (dt.date(2017, 2, 1),), (dt.date(2018, 3, 1),),
    ]
    with pytest.raises(ChecksFailed):
        build_warehouse(shop, root)


def test_period_filter_skips_folders(shop, root):
    from storelens.plans import sales
    from storelens.plans.filters import Filters

    stored = build_warehouse(shop, root, check=False)
    only = sales.revenue_yoy(stored, Filters(years=(2018,)))
    assert {r.year_number for r in only.collect()} == {2018}
    plan = only._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "line_total" in line)
    assert "order_month" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "PushedFilters: [" in scan


@pytest.mark.parametrize(
    "period",
    [
        {"years": (2016, 2018)},
        {"quarters": (1,)},
        {"start": dt.date(2017, 3, 1)},
        {"end": dt.date(2017, 3, 1)},
        {"start": dt.date(2016, 1, 1), "end": dt.date(2016, 12, 31)},
    ],
)
def test_every_form_of_period_skips_folders(shop, root, period):
    from storelens.plans import sales
    from storelens.plans.filters import Filters

    stored = build_warehouse(shop, root, check=False)
    bands = sales.revenue_bands(stored, Filters(**period))
    plan = bands._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "line_total" in line)
    assert "order_month" in scan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    days = {row[3] for row in shop.rows["orders"]}
    wanted = Filters(**period).period
    frame = stored.spark.createDataFrame([(d,) for d in days], "d date")
    assert (bands.count() > 0) == (frame.where(wanted(frame.d)).count() > 0)


def test_shares_scan_the_fact_twice(spark, shop, root):
    from storelens.plans.registry import all_shares

    stored = build_warehouse(shop, root, check=False)
    plan = plan_of(all_shares(stored))
    scans = [x for x in plan.splitlines() if "FileScan" in x and "fct_sales" in x]
    assert len(scans) <= 2, plan


def test_second_build_rewrites_changed_dates_only(spark, root):
    shop = Shop(spark)
    tables = [t for t in TABLES.values() if t.name != "stocks"]
    ingest(lambda t: shop.latest(t.name), tables, root, raw.Load(DAY2, "x"))

    def land(day, run_id, quantity):
        frame = Shop(spark, stocks=[(1, 1, quantity, day)]).history("stocks")
        raw.write_snapshot(frame, root, STOCKS, raw.Load(day, run_id))

    def files():
        _, state = read_state(spark, model_path(root, "fct_inventory_history"))
        return {day: part.version for day, part in state.items()}

    land(DAY1, "a", 4)
    land(DAY2, "a", 5)
    landed = LandedTables(spark, root)
    build_warehouse(landed, root, check=False)
    first = files()
    build_warehouse(landed, root, check=False)
    assert files() == first
    land(DAY2, "b", 6)
    stored = build_warehouse(landed, root, check=False)
    second = files()
    assert second[f"{DAY1}"] == first[f"{DAY1}"]
    assert second[f"{DAY2}"] != first[f"{DAY2}"]
    assert sorted(rows(stored("fct_inventory_history"), "snapshot_date", "quantity")) == [
        (DAY1, 4), (DAY2, 6),
    ]


def test_bad_staging_leaves_gold_untouched(spark, shop, root):
    build_warehouse(shop, root, check=False)
    before = rows(StoredStar(shop, root)("dim_store"))
    stores = [*shop.rows["stores"], shop.rows["stores"][0]]
    with pytest.raises(ChecksFailed, match="stg_stores.store_id unique"):
        build_warehouse(Shop(spark, stores=stores), root)
    assert sorted(rows(StoredStar(shop, root)("dim_store"))) == sorted(before)


def test_an_emptied_day_leaves_the_history(spark, root):
    products = stg_products(Shop(spark).latest("products"))
    target, state = f"{root}/history", f"{root}/state"
    filled = Shop(spark, stocks=[(1, 1, 3, DAY1), (1, 2, 4, DAY1)]).history("stocks")
    for run_id, frame in (("a", filled), ("b", filled.limit(0))):
        raw.write_snapshot(frame, root, STOCKS, raw.Load(DAY1, run_id))
        raw.write_snapshot(filled, root, STOCKS, raw.Load(DAY2, run_id))
        snapshot_stream(spark, root, products, target, state).awaitTermination()
    got = rows(read_history(spark, target), "snapshot_date", "quantity")
    landed = rows(LandedTables(spark, root).history("stocks"), "ingestion_date", "quantity")
    assert sorted(got) == sorted(landed) == [(DAY2, 3), (DAY2, 4)]


def test_split_column():
    from storelens.sources.jdbc import split_column

    assert split_column(STOCKS) == "product_id"
    assert split_column(TABLES["order_items"]) == "order_id"
    assert split_options("k", 1, 10, 10**10, 10**6, connections=8)["numPartitions"] == "8"


def test_stream_follows_new_loads(spark, root):
    products = stg_products(Shop(spark).latest("products"))
    target, state = f"{root}/history", f"{root}/state"

    def run():
        snapshot_stream(spark, root, products, target, state).awaitTermination()
        return sorted(rows(read_history(spark, target), "snapshot_date", "quantity"))

    def land_stocks(day, run_id, *quantities):
        stocks = [(1, 1 + i, q, day) for i, q in enumerate(quantities)]
        frame = Shop(spark, stocks=stocks).history("stocks")
        raw.write_snapshot(frame, root, STOCKS, raw.Load(day, run_id))

    land_stocks(DAY1, "b", 1, 2)
    assert run() == [(DAY1, 1), (DAY1, 2)]
    assert run() == [(DAY1, 1), (DAY1, 2)]
    land_stocks(DAY2, "b", 3)
    land_stocks(DAY1, "a", 5)  # a later load of the first day replaces it
    assert run() == [(DAY1, 5), (DAY2, 3)]


def test_connection_options():
    env = {
        "DATASOURCE_HOST": "db", "DATASOURCE_DATABASE": "shop", "DATASOURCE_USER": "u",
        "DATASOURCE_PASSWORD": "p",
    }
    connection = Connection.from_environment(env)
    assert connection.url == (
        "jdbc:postgresql://db:5432/shop?sslmode=require&connectTimeout=30"
    )
    assert connection.options()["fetchsize"] == "10000"
    assert split_options("order_id", 1, 10, 2_500_000, 1_000_000) == {
        "partitionColumn": "order_id", "lowerBound": "1", "upperBound": "11",
        "numPartitions": "3",
    }


def test_base_tables(spark):
    catalog = spark.createDataFrame(
        [
            ("sales", "orders", "BASE TABLE"),
            ("sales", "v", "VIEW"),
            ("pg_catalog", "pg_class", "BASE TABLE"),
            ("production", "brands", "BASE TABLE"),
        ],
        "table_schema string, table_name string, table_type string",
    )
    assert rows(base_tables(catalog)) == [("production", "brands"), ("sales", "orders")]
    assert rows(base_tables(catalog, "sales")) == [("sales", "orders")]


def test_object_store_settings():
    conf = object_store_conf({"AWS_ACCESS_KEY_ID": "k", "AWS_SECRET_ACCESS_KEY": "s"})
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "localhost:9000"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert lakehouse_root({}) == "s3a://lakehouse"


def test_scratch_paths_lie_in_the_shared_folder(spark):
    folder = shared_dir(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(folder)
    assert spark.range(3).select(F.col("id")).checkpoint().count() == 3
