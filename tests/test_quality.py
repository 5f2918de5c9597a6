import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from conftest import ROWS, Shop, plan_of, rows
from storelens.operators import quality
from storelens.operators.quality import Check, ChecksFailed, require_pass, run_checks
from storelens.plans.models import Star
from storelens.plans.suite import COMPOSITE_UNIQUE, SUITE, only


def failing(df):
    return {
        (r.model, r.column_name, r.test): r.failing_rows for r in df.collect() if r.failing_rows
    }


def sound(spark, **changes):
    """The shop without its deliberate faults."""
    fixed = {
        "products": [(1, "Alpha", 1, 1, 2018, 100), (2, "Beta", 2, 2, 2017, 50)],
        "customers": [(1, "Eve", "Stone", "e@x.com", "", "", "", "ca", "")],
        "orders": [(1, 1, 4, dt.date(2016, 2, 29), None, None, 1, 2)],
        "order_items": [(1, 1, 1, 1, 100, 0), (1, 2, 2, 2, 50, 0)],
        "staffs": ROWS["staffs"][:2],
        "stocks": [(1, 1, 3, dt.date(2018, 3, 1)), (2, 2, None, dt.date(2018, 3, 1))],
    }
    return Star(Shop(spark, **{**fixed, **changes}))


def test_the_suite_has_the_declared_checks():
    assert [len(only(t)) for t in ("unique", "not_null", "accepted_values", "relationships")] == [
        19, 91, 2, 8,
    ]
    assert len(SUITE) == len(set(SUITE)) == 120


def test_sound_data_passes(spark):
    results = run_checks(sound(spark), SUITE)
    assert results.count() == 120
    require_pass(results)


def test_every_fault_is_found(star):
    got = failing(run_checks(star, SUITE))
    assert got == {
        ("stg_customers", "last_name", "not_null"): 1,
        ("stg_customers", "full_name", "not_null"): 1,
        ("dim_customer", "last_name", "not_null"): 1,
        ("dim_customer", "full_name", "not_null"): 1,
        ("stg_products", "model_year", "not_null"): 1,
        ("dim_product", "brand_id", "not_null"): 1,
        ("dim_product", "brand_name", "not_null"): 1,
        ("dim_product", "category_id", "not_null"): 1,
        ("dim_product", "category_name", "not_null"): 1,
        ("stg_orders", "order_status_label", "not_null"): 1,
        ("fct_sales", "order_status_label", "not_null"): 1,
        ("stg_orders", "order_status", "accepted_values"): 1,
        ("fct_sales", "order_status", "accepted_values"): 1,
        ("fct_sales", "dim_customer_sk", "relationships"): 1,
    }
    with pytest.raises(ChecksFailed, match="14 checks failed"):
        require_pass(run_checks(star, SUITE))


def test_repeated_keys_count_once_per_value(spark):
    twice = ROWS["brands"] + ROWS["brands"] + [(1, "again")]
    got = failing(run_checks(sound(spark, brands=twice), only("unique")))
    assert got[("stg_brands", "brand_id", "unique")] == 2
    # the product join fans out, so the dimension's keys repeat too
    assert got[("dim_product", "dim_product_sk", "unique")] == 2


def test_a_natural_key_of_minus_one_meets_the_missing_member(spark):
    star = sound(spark, customers=[(-1, "Eve", "Stone", "e@x.com", "", "", "", "", "")])
    got = failing(run_checks(star, only("unique")))
    assert got[("dim_customer", "dim_customer_sk", "unique")] == 1


def test_orphans_count_rows_and_nulls_do_not(spark):
    items = [(1, i, 77, 1, 1, 0) for i in range(5)]
    got = failing(run_checks(sound(spark, order_items=items), only("relationships")))
    assert got == {("fct_sales", "dim_product_sk", "relationships"): 5}
    child = spark.createDataFrame([("a",), (None,), ("b",)], "k string")
    parent = spark.createDataFrame([("a",), (None,)], "k string")
    check = Check("child", "k", "relationships", parent="parent")
    result = run_checks({"child": child, "parent": parent}.__getitem__, [check])
    assert rows(result, "failing_rows", "status") == [(1, "fail")]


def test_empty_models_pass_key_checks(spark):
    star = sound(spark, orders=[], order_items=[])
    got = run_checks(star, [*only("unique"), *only("relationships")])
    assert got.count() == 27 and failing(got) == {}


def test_composite_grain(spark):
    stocks = [(1, 1, 3, dt.date(2018, 3, 1)), (1, 1, 4, dt.date(2018, 3, 1))]
    got = failing(run_checks(sound(spark, stocks=stocks), COMPOSITE_UNIQUE))
    assert set(got) == {
        ("fct_inventory", "inventory_pk", "unique"),
        ("fct_inventory_history", "inventory_pk", "unique"),
    }


def test_unique_keys_are_shuffled_before_they_are_counted(star):
    """They are as many as the rows: counted where they are read, they fill a task's memory."""
    plan = plan_of(run_checks(star, [Check("fct_sales", "sales_pk", "unique")]))
    assert "REPARTITION_BY_COL" in plan
    assert "REPARTITION_BY_COL" not in plan_of(run_checks(star, only("relationships")))


def test_hashes_of_unique_keys_are_shuffled_and_no_keys_in_a_sound_load(star):
    checks = run_checks(star, [Check("fct_sales", "sales_pk", "unique")])
    planned = checks._jdf.queryExecution().executedPlan().toString()
    by_hash, by_key = r"Exchange hashpartitioning\(check#\d+, hash#", r"Exchange hashpartitioning\(check#\d+, key#"
    assert re.search(by_hash, planned) and re.search(by_key, planned)
    assert not re.search(by_key, plan_of(checks))


@pytest.mark.parametrize("hashed", [F.xxhash64, lambda key: F.lit(7), lambda key: F.length(key).cast("long")])
@pytest.mark.parametrize("buckets", [1, 1 << 14])
def test_keys_whose_hashes_meet_are_told_apart(spark, monkeypatch, hashed, buckets):
    monkeypatch.setattr(quality, "_hash", hashed)
    monkeypatch.setattr(quality, "KEY_BUCKETS", buckets)
    models = {
        "some": spark.createDataFrame([("a",), ("b",), ("b",), ("cc",), (None,), (None,), ("",), ("",), ("b",)], "k string"),
        "sound": spark.createDataFrame([("a",), ("b",), ("cc",), (None,), (None,)], "k string"),
    }
    got = run_checks(models.__getitem__, [Check("some", "k", "unique"), Check("sound", "k", "unique")])
    assert {(r.model, r.failing_rows) for r in got.collect()} == {("some", 2), ("sound", 0)}


def test_repeated_and_null_keys(spark):
    orders = [(i % 3, 1, 4, dt.date(2016, 2, 29), None, None, 1, None) for i in range(5)]
    star = sound(spark, orders=[*orders, (9, 1, 4, dt.date(2016, 2, 29), None, None, 1, None)])
    got = run_checks(star, [Check("stg_orders", "order_id", "unique"), Check("stg_orders", "staff_id", "unique")])
    assert {(r.column_name, r.failing_rows) for r in got.collect()} == {("order_id", 2), ("staff_id", 0)}
