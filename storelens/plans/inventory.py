"""Inventory dashboard."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.functions.bands import alert_level, is_low_stock
from storelens.functions.numbers import MONEY_SUM, divide0, money_sum, percent, ratio
from storelens.operators.periods import snapshot_before
from storelens.operators.shares import total_of
from storelens.plans.filters import ALL, Filters
from storelens.plans.models import Star

MAX_THRESHOLD = 20
SUPPLY_WINDOW_DAYS = 90


def _sums(fact: DataFrame, *keys: str) -> DataFrame:
    return fact.groupBy(*keys).agg(
        F.sum("quantity").alias("units"), money_sum("inventory_value").alias("value")
    )


def _by_attribute(
    fact: DataFrame, dim: DataFrame, key: str, name: str, measure: str, out: str
) -> DataFrame:
    """Sums per key before the join, then per attribute."""
    sums = _sums(fact, key).select(key, measure)
    kind = sums.schema[measure].dataType
    return (
        sums.join(dim.select(key, name), key)
        .groupBy(name)
        .agg(F.sum(measure).cast(kind).alias(out))
    )


def inventory_kpis(star: Star, filters: Filters = ALL) -> DataFrame:
    """Products are counted by grouping on them; the store count reads only its own column."""
    fact = filters.inventory(star)
    stores = fact.agg(F.countDistinct("store_id")).scalar()
    low = F.count(F.when(is_low_stock(F.col("quantity"), filters.threshold), 1))
    per_product = fact.groupBy("product_id").agg(
        F.sum("quantity").alias("units"),
        money_sum("inventory_value").alias("value"),
        low.alias("low"),
    )
    totals = per_product.agg(
        F.sum("units").alias("total_units"),
        F.sum("value").cast("decimal(28,2)").alias("total_value"),
        F.coalesce(F.sum("low"), F.lit(0)).alias("low_stock_count"),
        F.count("product_id").alias("products"),
    )
    return totals.select(
        "total_units",
        "total_value",
        "low_stock_count",
        stores.alias("stores_covered"),
        divide0(F.col("total_units"), F.col("products")).alias("avg_units_per_product"),
    )


def inventory_value_by_store(star: Star, filters: Filters = ALL) -> DataFrame:
    return _by_attribute(
        filters.inventory(star), star("dim_store"), "dim_store_sk", "store_name",
        "value", "store_inventory_value",
    ).orderBy(F.desc("store_inventory_value"), "store_name")


def units_by_store(star: Star, filters: Filters = ALL) -> DataFrame:
    return _by_attribute(
        filters.inventory(star), star("dim_store"), "dim_store_sk", "store_name",
        "units", "units",
    ).orderBy(F.desc("units"), "store_name")


def _per_snapshot(star: Star, filters: Filters) -> DataFrame:
    """One row per snapshot date that is in the calendar, out of the sums kept with the history
    where there are such: they have the grain of every filter that a trend takes."""
    calendar = star("dim_date").select("dim_date_sk", F.col("date_day").alias("snapshot_date"))
    kept = filters.daily_inventory(star)
    if kept is None:
        sums = _sums(filters.inventory(star, history=True), "dim_date_sk")
    else:
        sums = kept.groupBy("dim_date_sk").agg(
            F.sum("units").alias("units"), F.sum("value").cast(MONEY_SUM).alias("value")
        )
    return sums.join(F.broadcast(calendar), "dim_date_sk").drop("dim_date_sk")


def inventory_trend(star: Star, filters: Filters = ALL) -> DataFrame:
    return (
        _per_snapshot(star, filters)
        .select("snapshot_date", F.col("units").alias("total_units"))
        .orderBy("snapshot_date")
    )


def units_by_category(star: Star, filters: Filters = ALL) -> DataFrame:
    return _by_attribute(
        filters.inventory(star), star("dim_product"), "dim_product_sk", "category_name",
        "units", "units_on_hand",
    ).orderBy(F.desc("units_on_hand"), "category_name")


def inventory_value_by_brand(star: Star, filters: Filters = ALL) -> DataFrame:
    """Shares are of all brands, whichever are chosen."""
    value = "brand_inventory_value"
    groups = _by_attribute(
        replace(filters, brands=()).inventory(star), star("dim_product"), "dim_product_sk",
        "brand_name", "value", value,
    )
    shares = groups.withColumn("pct", percent(F.col(value), total_of(groups, value)))
    if filters.brands:
        shares = shares.where(F.col("brand_name").isin(*filters.brands))
    return shares.orderBy(F.desc(value), "brand_name")


def low_stock_alerts(star: Star, filters: Filters = ALL) -> DataFrame:
    """The filter on quantity comes first, so only the low rows meet the dimensions."""
    low = filters.inventory(star).where(is_low_stock(F.col("quantity"), filters.threshold))
    products = star("dim_product").select(
        "dim_product_sk",
        "product_name",
        "brand_name",
        "category_name",
        F.col("list_price").alias("unit_price"),
    )
    return (
        low.join(star("dim_store").select("dim_store_sk", "store_name"), "dim_store_sk")
        .join(products, "dim_product_sk")
        .select(
            "store_name",
            "product_id",
            "product_name",
            "brand_name",
            "category_name",
            "quantity",
            "unit_price",
            "inventory_value",
            "snapshot_date",
            alert_level(F.col("quantity")).alias("alert_level"),
        )
        .orderBy("quantity", F.desc("inventory_value"), "store_name", "product_id")
    )


def alert_level_counts(star: Star, filters: Filters = ALL) -> DataFrame:
    level = alert_level(F.col("quantity")).alias("alert_level")
    return filters.inventory(star).groupBy(level).agg(F.count(F.lit(1)).alias("rows"))


def low_stock_by_threshold(star: Star, filters: Filters = ALL) -> DataFrame:
    """A row counts for its quantity and every threshold above it. Rows are counted once per
    lowest threshold, of which there are 20; the running sum is over those."""
    lowest = F.greatest("quantity", F.lit(1))
    counts = (
        filters.inventory(star)
        .where(F.col("quantity") <= MAX_THRESHOLD)
        .groupBy(lowest.alias("lowest"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    covered = F.explode(F.sequence("lowest", F.lit(MAX_THRESHOLD))).alias("threshold")
    none = star.spark.range(1, MAX_THRESHOLD + 1, 1, 1).select(
        F.lit(0).cast("bigint").alias("rows"), F.col("id").cast("int").alias("threshold")
    )
    return (
        counts.select("rows", covered)
        .unionByName(none)
        .groupBy("threshold")
        .agg(F.sum("rows").alias("low_stock_count"))
        .orderBy("threshold")
    )


def snapshot_dates(star: Star, filters: Filters = ALL) -> DataFrame:
    history = filters.inventory(star, history=True)
    return history.select("snapshot_date").distinct().orderBy("snapshot_date")


def snapshot_change(star: Star, filters: Filters = ALL) -> DataFrame:
    compared = _per_snapshot(star, filters)
    columns = [F.col("snapshot_date")]
    for m in ("units", "value"):
        prior = snapshot_before(m)
        change = F.col(m) - prior
        columns += [
            F.col(m),
            prior.alias(f"prior_{m}"),
            change.cast(compared.schema[m].dataType).alias(f"{m}_change"),
            (divide0(change, prior) * 100).alias(f"{m}_change_pct"),
        ]
    return compared.select(*columns).orderBy("snapshot_date")


def snapshot_as_of(star: Star, snapshot: dt.date, filters: Filters = ALL) -> DataFrame:
    """The KPI cards of a chosen snapshot; every query here takes the date the same way."""
    return inventory_kpis(star, replace(filters, snapshot=snapshot))


def store_inventory_share(star: Star, filters: Filters = ALL) -> DataFrame:
    """Value share against all stores; brand and category filters stay in the total."""
    groups = _by_attribute(
        replace(filters, stores=()).inventory(star), star("dim_store"), "dim_store_sk",
        "store_name", "value", "value",
    )
    share = divide0(F.col("value"), total_of(groups, "value")) * 100
    shares = groups.withColumn("share_pct", share)
    if filters.stores:
        shares = shares.where(F.col("store_name").isin(*filters.stores))
    return shares.orderBy(F.desc("value"), "store_name")


def is_low_stock_rows(star: Star, filters: Filters = ALL) -> DataFrame:
    flag = is_low_stock(F.col("quantity"), filters.threshold).alias("is_low_stock")
    return filters.inventory(star).select("store_id", "product_id", "quantity", flag)


def low_stock_products(star: Star, filters: Filters = ALL) -> DataFrame:
    """Products whose lowest stock at any store is at or below the threshold."""
    lowest = F.min("quantity").alias("lowest_quantity")
    return (
        filters.inventory(star)
        .groupBy("product_id")
        .agg(lowest)
        .where(is_low_stock(F.col("lowest_quantity"), filters.threshold))
    )


def days_of_supply(
    star: Star, filters: Filters = ALL, window_days: int = SUPPLY_WINDOW_DAYS
) -> DataFrame:
    """Quantity over the average units sold per day at that store in the days before the
    snapshot; NULL where nothing was sold."""
    keys = ["dim_store_sk", "dim_product_sk"]
    stock = filters.inventory(star)
    snapshot = stock.agg(F.max("snapshot_date")).scalar()
    first_day = F.date_sub(snapshot, window_days)
    sales = star("fct_sales").where(
        (F.col("order_date") >= first_day) & (F.col("order_date") < snapshot)
    )
    if "order_month" in sales.columns:  # a stored fact: read the window's folders only
        sales = sales.where(
            F.col("order_month").between(F.trunc(first_day, "month"), snapshot)
        )
    sold = sales.groupBy(*keys).agg(F.sum("quantity").alias("units_sold"))
    units = F.coalesce("units_sold", F.lit(0).cast("bigint"))
    velocity = units.cast("double") / window_days
    return stock.join(sold, keys, "left").select(
        "store_id",
        "product_id",
        "snapshot_date",
        "quantity",
        units.alias("units_sold"),
        velocity.alias("avg_daily_units"),
        ratio(F.col("quantity"), velocity).alias("days_of_supply"),
    )
