import datetime as dt
from decimal import Decimal

import pytest

from conftest import Shop, rows
from storelens.operators.ranking import dense_rank_desc, top_with_ties
from storelens.plans import inventory, performance, sales
from storelens.plans.filters import Filters
from storelens.plans.models import Star

NOTHING = Filters(years=(2030,))


def test_kpis(star):
    got = sales.sales_kpis(star).first()
    assert got.total_revenue == Decimal("409.00")
    assert got.total_orders == 5 and got.units_sold == 13
    assert got.avg_order_value == pytest.approx(81.8)
    assert got.fulfillment_rate_pct == pytest.approx(40.0)


def test_no_rows_give_null_sums_and_zero_ratios(star):
    got = sales.sales_kpis(star, NOTHING).first()
    assert (got.total_revenue, got.units_sold, got.total_orders) == (None, None, 0)
    assert (got.avg_order_value, got.fulfillment_rate_pct) == (0.0, 0.0)
    assert sales.order_status_distribution(star, NOTHING).collect() == []
    best = performance.top_brand(star, NOTHING).first()
    assert (best.brand_name, best.revenue) == (None, None)


def test_leap_day_compares_with_february(star):
    got = {(r.year_number, r.month_number): r for r in sales.revenue_yoy(star).collect()}
    assert got[2016, 2].py_revenue is None and got[2016, 2].yoy_growth_pct == 0.0
    assert got[2017, 2].py_revenue == Decimal("200.00")
    assert got[2017, 2].yoy_growth_pct == pytest.approx(-50.0)
    # the months with sales, and those a year after them
    assert set(got) == {(2016, 2), (2017, 2), (2018, 2), (2018, 3), (2019, 3)}


def test_period_filter_still_finds_the_year_before(star):
    only = sales.revenue_yoy(star, Filters(years=(2017,))).collect()
    assert [(r.year_number, r.revenue, r.py_revenue) for r in only] == [
        (2017, Decimal("100.00"), Decimal("200.00"))
    ]
    year = sales.kpis_yoy(star, Filters(years=(2017,))).first()
    assert (year.total_orders, year.py_total_orders) == (1, 1)
    assert year.total_revenue_change_pct == pytest.approx(-50.0)


def test_offsets(star):
    got = {
        (r.year_number, r.years_back): r.earlier_revenue
        for r in sales.revenue_n_years_ago(star).collect()
    }
    assert got[2017, 1] == Decimal("200.00") and got[2017, 2] is None
    # a month and offset shows if either month has sales
    assert len(got) == 15


def test_tied_brands_are_multiple(spark, star):
    best = performance.top_brand(star).first()
    assert (best.brand_name, best.revenue) == ("Multiple", Decimal("400.00"))
    alone = performance.top_brand(star, Filters(years=(2018,))).first()
    assert (alone.brand_name, alone.revenue) == ("Surly", Decimal("100.00"))


def test_share_is_against_all_stores_and_products(star):
    one = Filters(stores=("North",))
    got = {r.name: r.share_pct for r in sales.revenue_share(star, "store", one).collect()}
    assert got == {"North": pytest.approx(309 / 409 * 100)}
    every = {r.name: r.share_pct for r in sales.revenue_share(star, "store").collect()}
    assert sum(every.values()) == pytest.approx(100.0)


def test_guests_are_one_labelled_row(star):
    names = [r.customer_name for r in performance.top_customers(star).collect()]
    assert names == ["Eve Stone", "Unknown Customer", None]
    assert {r.customer_type: r.orders for r in performance.guest_revenue(star).collect()} == {
        "Guest": 1,
        "Registered": 4,
    }
    assert rows(performance.repeat_customers(star), "customer_id", "orders") == [(1, 2)]


def test_leaderboard_has_active_staff_only(star):
    board = performance.staff_leaderboard(star).collect()
    assert [(r.staff_id, r.manager_full_name, r.revenue_rank) for r in board] == [
        (2, "Ann Boss", 1),
        (1, None, 2),
    ]
    everyone = performance.staff_leaderboard(star, Filters(active_only=False))
    assert {r.staff_id for r in everyone.collect()} == {1, 2, 3}


def test_unknown_model_year_group(star):
    got = dict(
        rows(performance.revenue_by_model_year_group(star), "model_year_group", "revenue")
    )
    assert got["Unknown"] == Decimal("9.00") and set(got) == {
        "2018 (Current)", "2017", "Unknown",
    }


def test_alert_levels(star):
    alerts = inventory.low_stock_alerts(star, Filters(threshold=6)).collect()
    assert [(r.quantity, r.alert_level) for r in alerts] == [
        (0, "Critical"), (0, "Critical"), (2, "Critical"), (3, "Warning"), (5, "Warning"),
        (6, "OK"),
    ]
    assert len(inventory.low_stock_alerts(star).collect()) == 5


def test_thresholds(star):
    got = dict(rows(inventory.low_stock_by_threshold(star)))
    assert len(got) == 20
    assert (got[1], got[2], got[3], got[5], got[20]) == (2, 3, 4, 5, 6)
    none = dict(rows(inventory.low_stock_by_threshold(star, Filters(stores=("Nowhere",)))))
    assert set(none.values()) == {0} and len(none) == 20


def test_snapshots(star):
    got = inventory.snapshot_change(star).collect()
    assert [(r.units, r.prior_units, r.units_change) for r in got] == [
        (40, None, None),
        (16, 40, -24),
    ]
    assert got[0].units_change_pct == 0.0 and got[1].units_change_pct == pytest.approx(-60.0)
    kpis = inventory.snapshot_as_of(star, dt.date(2018, 3, 1)).first()
    assert (kpis.total_units, kpis.stores_covered, kpis.low_stock_count) == (40, 2, 1)
    assert kpis.avg_units_per_product == 40.0


def test_days_of_supply(star):
    got = {(r.store_id, r.product_id): r for r in inventory.days_of_supply(star).collect()}
    assert got[2, 2].units_sold == 2
    assert got[2, 2].days_of_supply == pytest.approx(5 / (2 / 90))
    assert got[1, 1].units_sold == 0 and got[1, 1].days_of_supply is None


def test_filters(star):
    def orders(**chosen):
        return sales.sales_kpis(star, Filters(**chosen)).first().total_orders

    assert orders(years=(2016, 2017)) == 2
    assert orders(years=(2018,), quarters=(2,)) == 0
    assert orders(quarters=(1,)) == 5
    assert orders(start=dt.date(2018, 3, 6), end=dt.date(2018, 3, 6)) == 1
    assert orders(stores=("South",)) == 2
    assert orders(stores=("South",), store_scope="staff") == 1
    assert orders(categories=("Road",)) == 2
    assert orders(brands=("Surly",), statuses=("Pending",)) == 1
    assert orders(staff=("Ann Boss",)) == 2
    assert Filters.first_load(dt.date(2018, 5, 5)) == Filters(years=(2018,))


def test_quarter_ranges():
    last = Filters(years=(2016,), quarters=(1, 4))._ranges(2016)
    assert last == [
        (dt.date(2016, 1, 1), dt.date(2016, 3, 31)),
        (dt.date(2016, 10, 1), dt.date(2016, 12, 31)),
    ]


def test_ranking_has_no_gaps_and_puts_null_last(spark):
    groups = spark.range(3000).selectExpr(
        "id as name",
        "cast(case when id % 3 = 0 then 5 when id = 1 then null else id % 700 end "
        "as decimal(28,2)) as revenue",
    )
    values = sorted({r.revenue for r in groups.collect() if r.revenue is not None}, reverse=True)
    ranked = dense_rank_desc(groups, "revenue", "place")
    assert ranked.count() == 3000
    got = dict(rows(ranked, "revenue", "place"))
    assert [got[v] for v in values] == list(range(1, len(values) + 1))
    assert got[None] == len(values) + 1


def test_ranking_of_negative_and_close_values(spark):
    values = [Decimal(v) for v in ("-5.01", "-5.00", "0.00", "0.01", "99999999999.99", "100000000000.00")]
    groups = spark.createDataFrame([(v,) for v in values], "revenue decimal(28,2)")
    got = dict(rows(dense_rank_desc(groups, "revenue", "place"), "revenue", "place"))
    assert [got[v] for v in values] == [6, 5, 4, 3, 2, 1]


def test_building_a_ranking_runs_no_job_and_leaves_no_file(spark):
    import os

    from storelens.session import shared_dir

    before = sum(len(files) for _, _, files in os.walk(shared_dir(spark)))
    groups = spark.range(10).selectExpr("id as revenue")
    # a job would fail on this division
    broken = groups.selectExpr("cast(assert_true(revenue < 5) as string) as a", "revenue")
    dense_rank_desc(broken, "revenue", "place")
    assert dense_rank_desc(groups, "revenue", "place").count() == 10
    assert sum(len(files) for _, _, files in os.walk(shared_dir(spark))) == before


def test_money_sums_past_the_range_of_integers(spark):
    from storelens.functions.numbers import money_sum

    largest = Decimal("9999999999999999.99")
    frame = spark.createDataFrame([(largest,)] * 12, "line_total decimal(18,2)")
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for ansi in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            assert frame.agg(money_sum("line_total")).first()[0] == largest * 12
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_shares_under_their_own_filter_are_of_everything(star):
    def share(query, column, **filters):
        return {r[0]: r[column] for r in query(star, Filters(**filters)).collect()}

    whole = share(performance.revenue_by_brand, "share_pct")
    assert share(performance.revenue_by_brand, "share_pct", brands=("Surly",)) == {"Surly": whole["Surly"]}
    whole = share(performance.category_revenue_share, "revenue_pct")
    assert share(performance.category_revenue_share, "revenue_pct", categories=("Kids",)) == {"Kids": whole["Kids"]}
    whole = share(inventory.inventory_value_by_brand, "pct")
    assert share(inventory.inventory_value_by_brand, "pct", brands=("Surly",)) == {"Surly": whole["Surly"]}


def test_a_month_that_fell_to_nothing_keeps_its_earlier_value(star):
    months = {(r.year_number, r.month_number): r for r in sales.revenue_yoy(star).collect()}
    lost = months[2019, 3]  # March 2018 sold, March 2019 did not
    assert lost.revenue is None and lost.py_revenue == months[2018, 3].revenue
    assert lost.yoy_growth_pct == -100.0
    years = {r.year_number: r for r in sales.kpis_yoy(star).collect()}
    assert years[2019].total_revenue is None and years[2019].total_revenue_change_pct == -100.0


def test_top_with_ties(spark):
    groups = spark.createDataFrame([("a", 3), ("b", 2), ("c", 2), ("d", 1)], "n string, v int")
    assert sorted(rows(top_with_ties(groups, "v", 2), "n")) == [("a",), ("b",), ("c",)]


def test_a_hot_key_changes_nothing(spark):
    """A third of all orders are guests of one store buying one product."""
    orders = [
        (i, None if i % 3 == 0 else 1, 4, dt.date(2018, 1, 1 + i % 28), None, None, 1, 2)
        for i in range(600)
    ]
    items = [(i, 1, 1 if i % 3 == 0 else 2, 1, 10, 0) for i in range(600)]
    star = Star(Shop(spark, orders=orders, order_items=items))
    guests = {r.customer_type: (r.orders, r.revenue) for r in
              performance.guest_revenue(star).collect()}
    assert guests == {
        "Guest": (200, Decimal("2000.00")),
        "Registered": (400, Decimal("4000.00")),
    }
    assert dict(rows(sales.revenue_by_category(star))) == {
        "Kids": Decimal("4000.00"), "Road": Decimal("2000.00"),
    }
