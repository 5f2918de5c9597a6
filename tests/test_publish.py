"""Versions and their log, builds that stop behind a failed check, one record for two writers."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import DAY1, DAY2, Shop, rows
from storelens.operators.quality import ChecksFailed
from storelens.operators.staging import stg_products
from storelens.plans import inventory
from storelens.plans.filters import Filters
from storelens.plans.models import LandedTables, Star, StoredStar, levels, model_path
from storelens.plans.warehouse import BUILD_ORDER, build_inputs, build_warehouse, ingest
from storelens.session import create_once, list_names, read_text
from storelens.sources import raw, versions
from storelens.sources.schemas import TABLES
from storelens.sources.versions import NotPublished, Part
from storelens.streaming import snapshots
from storelens.streaming.snapshots import HISTORY, STOCKS, read_history, snapshot_stream, update_history
from test_quality import sound


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


def good(spark, **changes):
    return sound(spark, **changes).sources


# --- the log -----------------------------------------------------------------------------------


def test_a_file_is_created_once(spark, root):
    assert create_once(spark, f"{root}/a/1", "x")
    assert not create_once(spark, f"{root}/a/1", "y")
    assert read_text(spark, f"{root}/a/1") == "x" and list_names(spark, f"{root}/a") == ["1"]
    assert list_names(spark, f"{root}/none") == []


def test_commits_meet_in_the_log(spark, root):
    """A writer that another got ahead of sees the other's entry and keeps it."""

    def change(state):
        if not state:
            versions.commit(spark, root, lambda s: {**s, "b": Part("2")})
        return {**state, "a": Part("1")}

    versions.commit(spark, root, change)
    assert versions.read_state(spark, root) == (2, {"a": Part("1"), "b": Part("2")})


def test_old_versions_go_and_unfinished_ones_stay(spark, root):
    for version in ("1", "2", "3", "unfinished"):
        spark.range(1).write.parquet(versions.version_path(root, version))
        if version != "unfinished":
            versions.publish(spark, root, version)
    versions.drop_old_versions(spark, root, keep=2)
    assert sorted(n for n in os.listdir(root) if n.startswith("v=")) == ["v=2", "v=3", "v=unfinished"]
    assert versions.current(spark, root, "id bigint").count() == 1
    assert len(list_names(spark, f"{root}/_commits")) == 2


def test_nothing_published(spark, root):
    with pytest.raises(NotPublished, match="dim_store"):
        StoredStar(good(spark), root)("dim_store")


# --- order and gate ----------------------------------------------------------------------------


def test_levels_come_from_the_inputs():
    assert levels({"c": {"b"}, "a": set(), "b": {"a"}, "d": {"a"}}) == [["a"], ["b", "d"], ["c"]]
    with pytest.raises(Exception, match="cycle|nodes"):
        levels({"a": {"b"}, "b": {"a"}})
    with pytest.raises(ValueError, match="no such models: x"):
        levels({"a": {"x"}})
    for check in (True, False):
        inputs, done = build_inputs(check), set()
        for level in levels(inputs):
            assert all(inputs[name] <= done for name in level)
            done |= set(level)
        assert done == set(BUILD_ORDER)
    # keys are checked against what they refer to, so those come first
    assert {"dim_store", "dim_customer"} <= build_inputs(True)["fct_sales"]
    assert "dim_store" not in build_inputs(False)["fct_sales"]


def test_a_failed_gold_check_leaves_the_old_version_current(spark, root):
    build_warehouse(good(spark), root)
    # the new line's product is unknown, and a store has another name
    import datetime as dt

    bad = good(
        spark,
        orders=[(9, 1, 4, dt.date(2018, 2, 1), None, None, 1, 2)],
        order_items=[(9, 1, 77, 1, 100, 0)],
        stores=[(1, "Changed", "", "", "", "", "", ""), (2, "South", "", "", "", "", "", "")],
    )
    with pytest.raises(ChecksFailed, match="fct_sales.dim_product_sk relationships: 1") as error:
        build_warehouse(bad, root)
    assert "1 models are not current" in str(error.value)
    stored = StoredStar(bad, root)
    assert sorted(rows(stored("fct_sales"), "order_id", "item_id")) == [(1, 1), (1, 2)]
    assert ("Changed",) in rows(stored("dim_store"), "store_name")
    build_warehouse(good(spark), root)
    assert ("Changed",) not in rows(stored.__class__(bad, root)("dim_store"), "store_name")


def test_a_failed_check_stops_only_what_lies_behind_it(spark, root):
    build_warehouse(good(spark), root)
    shop = good(spark)
    stores = [*shop.rows["stores"], shop.rows["stores"][0]]
    changed = good(spark, stores=stores, brands=[(1, "New"), (2, "Surly")])
    with pytest.raises(ChecksFailed) as error:
        build_warehouse(changed, root)
    said = str(error.value)
    assert "stg_stores.store_id unique: 1" in said and "dim_store: not built, it needs stg_stores" in said
    assert "fct_sales: not built, it needs dim_store" in said
    assert "dim_product" not in said and "dim_customer" not in said
    stored = StoredStar(changed, root)
    assert ("New",) in rows(stored("dim_product"), "brand_name")
    assert len(rows(stored("dim_store"))) == len(shop.rows["stores"]) + 1
    assert stored("fct_sales").count() == 2


def test_readers_keep_what_they_have_opened(spark, root):
    stored = build_warehouse(good(spark), root)
    opened = stored("dim_store")
    build_warehouse(good(spark, stores=[(1, "Other", "", "", "", "", "", "")]), root, check=False)
    assert ("Other",) not in rows(opened, "store_name")
    assert ("Other",) in rows(StoredStar(good(spark), root)("dim_store"), "store_name")


# --- one record per date for builds and streams --------------------------------------------------


@pytest.fixture
def landed(spark, root):
    tables = [t for t in TABLES.values() if t.name != "stocks"]
    ingest(lambda t: Shop(spark).latest(t.name), tables, root, raw.Load(DAY2, "x"))
    land(spark, root, DAY1, "a", (1, 1, 4), (2, 2, 7))
    land(spark, root, DAY2, "a", (1, 1, 5))
    return LandedTables(spark, root)


def land(spark, root, day, run_id, *stocks):
    frame = Shop(spark, stocks=[(*s, day) for s in stocks]).history("stocks")
    raw.write_snapshot(frame, root, STOCKS, raw.Load(day, run_id))


def stream(spark, root, products):
    target = model_path(root, HISTORY)
    snapshot_stream(spark, root, products, target, f"{root}/state").awaitTermination()


def written(spark, root):
    number, state = versions.read_state(spark, model_path(root, HISTORY))
    return number, {day: part.version for day, part in state.items()}


def test_a_build_after_a_stream_writes_no_date(spark, root, landed):
    products = stg_products(Shop(spark).latest("products"))
    stream(spark, root, products)
    before = written(spark, root)
    stored = build_warehouse(landed, root, check=False)
    assert written(spark, root) == before
    land(spark, root, DAY2, "b", (1, 1, 6))
    build_warehouse(landed, root, check=False)
    number, state = written(spark, root)
    assert number == before[0] + 1 and state[f"{DAY1}"] == before[1][f"{DAY1}"]
    stream(spark, root, products)
    assert written(spark, root) == (number, state)
    assert sorted(rows(read_history(spark, model_path(root, HISTORY)), "snapshot_date", "quantity")) == [
        (DAY1, 4), (DAY1, 7), (DAY2, 6),
    ]
    assert stored("stg_products").count() == 3


def test_a_writer_that_dies_before_its_record_leaves_the_date_to_be_written(spark, root, landed, monkeypatch):
    target, products = model_path(root, HISTORY), stg_products(Shop(spark).latest("products"))
    update_history(spark, root, products, target)
    land(spark, root, DAY2, "b", (1, 1, 9))
    with monkeypatch.context() as patched:
        patched.setattr(versions, "create_once", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            update_history(spark, root, products, target)
    assert sorted(rows(read_history(spark, target), "quantity")) == [(4,), (5,), (7,)]
    assert update_history(spark, root, products, target) == [f"{DAY2}"]
    assert sorted(rows(read_history(spark, target), "quantity")) == [(4,), (7,), (9,)]
    assert update_history(spark, root, products, target) == []


def test_two_writers_of_a_date_leave_the_newest_load(spark, root, landed, monkeypatch):
    """The first writer has written an older load when a second one lands and is written."""
    target, products = model_path(root, HISTORY), stg_products(Shop(spark).latest("products"))
    plain, between = versions.commit, []

    def commit(spark, table, change):
        if not between:
            between.append(1)
            land(spark, root, DAY2, "late", (1, 1, 11))
            update_history(spark, root, products, target)
        return plain(spark, table, change)

    monkeypatch.setattr(versions, "commit", commit)
    update_history(spark, root, products, target)
    monkeypatch.undo()
    assert sorted(rows(read_history(spark, target), "quantity")) == [(4,), (7,), (11,)]
    assert update_history(spark, root, products, target) == []


def test_new_prices_write_all_dates(spark, root, landed):
    target = model_path(root, HISTORY)
    update_history(spark, root, stg_products(Shop(spark).latest("products")), target)
    dearer = [(1, "Alpha", 1, 1, 2018, 200), (2, "Beta", 2, 2, 2017, 50)]
    products = stg_products(Shop(spark, products=dearer).latest("products"))
    assert update_history(spark, root, products, target) == [f"{DAY1}", f"{DAY2}"]
    assert sorted(rows(read_history(spark, target), "quantity", "inventory_value"))[0] == (4, 800)


# --- sums kept with the history ------------------------------------------------------------------

TREND_FILTERS = [
    Filters(), Filters(stores=("North",)), Filters(brands=("Trek",)), Filters(categories=("Kids", "Road")),
    Filters(stores=("South",), brands=("Surly",), categories=("Kids",)), Filters(snapshot=DAY2),
]


def assert_trends(spark, root):
    landed = LandedTables(spark, root)
    stored, computed = StoredStar(landed, root), Star(landed)
    assert stored.daily_inventory() is not None and computed.daily_inventory() is None
    for filters in TREND_FILTERS:
        for query in (inventory.inventory_trend, inventory.snapshot_change):
            assert rows(query(stored, filters)) == rows(query(computed, filters)), filters
    plan = inventory.inventory_trend(stored)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    read = [line for line in scans if "units" in line]
    assert len(read) == 1 and len(scans) == 2 and not any("quantity" in line for line in scans), plan


def test_kept_sums_equal_the_full_scan(spark, root, landed):
    build_warehouse(landed, root, check=False)
    assert_trends(spark, root)
    # a reload, a day that is emptied, a new day, and a product that changes its brand
    land(spark, root, DAY1, "b", (1, 1, 1), (1, 3, 2), (2, 2, None), (2, 99, 4))
    land(spark, root, DAY2, "b")
    land(spark, root, DAY2.replace(day=30), "c", (1, 2, 3))
    build_warehouse(landed, root, check=False)
    assert_trends(spark, root)
    moved = [(1, "Alpha", 2, 1, 2018, 100), (2, "Beta", 2, None, 2017, 50)]
    products = Shop(spark, products=moved).latest("products")
    raw.write_snapshot(products, root, TABLES["products"], raw.Load(DAY2, "y"))
    build_warehouse(landed, root, check=False)
    assert_trends(spark, root)


def test_daily_sums_take_a_row_per_group(spark, landed):
    products = stg_products(Shop(spark).latest("products"))
    history = Star(landed)("fct_inventory_history")
    sums = snapshots.daily_sums(history, products)
    assert sums.agg(F.sum("units")).first()[0] == history.agg(F.sum("quantity")).first()[0]
    assert sums.groupBy("snapshot_date", "dim_store_sk", "brand_id", "category_id").count().where("count > 1").count() == 0
