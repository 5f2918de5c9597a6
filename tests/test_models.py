import datetime as dt
import hashlib
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import Shop, rows
from storelens.functions.keys import NULL_MARKER, keyed_nulls, surrogate_key
from storelens.operators.dimensions import date_spine, dim_date
from storelens.operators.facts import resolve_orphans
from storelens.plans.models import Star


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


MISSING = md5("-1")


def test_surrogate_key_texts(spark):
    df = spark.sql(
        "select 7 as a, cast(null as int) as b, date '2018-03-01' as d, cast(1 as bigint) as c"
    )
    got = df.select(
        surrogate_key("a", "b").alias("ab"),
        surrogate_key("d").alias("d"),
        keyed_nulls("b").alias("b"),
        keyed_nulls("c").alias("c"),
        surrogate_key("b").alias("plain"),
    ).first()
    assert got.ab == md5(f"7-{NULL_MARKER}")
    assert got.d == md5("2018-03-01")
    assert got.b == MISSING
    assert got.c == md5("1")
    assert got.plain == md5(NULL_MARKER)


def test_staging_cleans_text(star):
    eve, max_ = star("stg_customers").orderBy("customer_id").collect()
    assert (eve.first_name, eve.full_name, eve.email) == ("Eve", "Eve Stone", "e@x.com")
    assert (eve.phone, eve.street, eve.state, eve.zip_code) == (None, None, "CA", "1")
    assert max_.full_name is None and max_.city is None and max_.zip_code is None


def test_store_email_keeps_its_case(star):
    assert rows(star("stg_stores").orderBy("store_id"), "email") == [("N@x.com",), ("S@x.com",)]


def test_unknown_status_has_no_label(star):
    got = dict(rows(star("stg_orders"), "order_id", "order_status_label"))
    assert got == {1: "Completed", 2: "Completed", 3: "Pending", 4: "Rejected", 5: None}


def test_line_totals(star):
    got = rows(star("stg_order_items").orderBy("order_id", "item_id"), "line_total")
    assert [r[0] for r in got] == [Decimal(v) for v in ("100", "100", "100", "100", "0", "9")]


def test_unmatched_brand_gives_null_ids(star):
    product = star("dim_product").where("product_id = 3").first()
    assert (product.brand_id, product.brand_name) == (None, None)
    assert (product.category_id, product.category_name) == (None, None)


def test_missing_members(star):
    for dim, name in (
        ("dim_customer", "Unknown Customer"),
        ("dim_product", "Unknown Product"),
        ("dim_store", "Unknown Store"),
        ("dim_staff", "Unknown Staff"),
    ):
        row = star(dim).where(F.col(f"{dim}_sk") == MISSING).collect()
        assert len(row) == 1 and name in tuple(row[0])
        assert -1 in tuple(row[0])
    staff = star("dim_staff").where("staff_id = -1").first()
    assert staff.is_active is False and staff.manager_dim_staff_sk == MISSING


def test_managers(star):
    got = {
        r.staff_id: (r.manager_dim_staff_sk, r.manager_full_name)
        for r in star("dim_staff").collect()
    }
    assert got[1] == (MISSING, None)
    assert got[2] == (md5("1"), "Ann Boss")
    assert got[3] == (md5("999"), None)


def test_default_calendar(spark):
    days = dim_date(date_spine(spark))
    assert days.count() == 7306
    got = {r.date_day: r for r in days.collect()}
    assert got[None].dim_date_sk == MISSING and got[None].year_number is None
    assert max(d for d in got if d) == dt.date(2034, 12, 31)
    sunday, leap, week = (
        got[dt.date(2015, 1, 4)],
        got[dt.date(2016, 2, 29)],
        got[dt.date(2016, 1, 1)],
    )
    assert (sunday.day_of_week, sunday.is_weekend, sunday.day_name) == (0, True, "Sunday")
    assert (leap.month_name, leap.quarter_label, leap.day_of_month) == ("February", "Q1", 29)
    assert week.week_of_year == 53 and not week.is_weekend


def test_sales_fact_keys(star):
    fact = {(r.order_id, r.item_id): r for r in star("fct_sales").collect()}
    assert len(fact) == 6
    assert fact[1, 2].sales_pk == md5("1-2")
    assert fact[3, 1].dim_customer_sk == MISSING
    assert fact[4, 1].dim_customer_sk == md5("999999")
    assert fact[1, 1].dim_date_sk == md5("2016-02-29")
    assert fact[1, 1].is_shipped and not fact[3, 1].is_shipped


def test_resolve_orphans_is_opt_in(star):
    fact = resolve_orphans(star("fct_sales"), star("dim_customer"), "dim_customer_sk")
    got = dict(rows(fact.where("item_id = 1"), "order_id", "dim_customer_sk"))
    assert got[4] == got[3] == MISSING and got[1] == md5("1")
    assert fact.columns == star("fct_sales").columns and fact.count() == 6


def test_inventory_is_the_newest_snapshot(star):
    got = {(r.store_id, r.product_id): r for r in star("fct_inventory").collect()}
    assert len(got) == 6
    assert got[1, 1].quantity == 0 and got[1, 1].inventory_value == 0
    assert got[2, 2].inventory_value == Decimal("250.00")
    assert got[2, 2].inventory_pk == md5("2-2")
    history = star("fct_inventory_history")
    assert history.count() == 8
    assert history.select("inventory_pk").distinct().count() == 8


def test_null_price_gives_null_value(spark):
    star = Star(Shop(spark, products=[(1, "Alpha", 1, 1, 2018, None)]))
    got = dict(rows(star("fct_inventory").where("store_id = 2"), "product_id", "inventory_value"))
    assert got == {1: None, 2: None, 3: None}
