"""Facts. Only keys and degenerate dimensions are stored; attributes stay in the dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.functions.bands import order_status_label
from storelens.functions.keys import keyed_nulls, missing_key, surrogate_key
from storelens.functions.numbers import inventory_value, line_total

# Tasks that the rows of a stored snapshot date are spread over; more if they are very large.
TASKS_PER_DATE = 32


def _derived() -> dict[str, Column]:
    """The columns that staging derives from others of the same table."""
    return {
        "order_status_label": order_status_label("order_status"),
        "is_shipped": F.col("shipped_date").isNotNull(),
        "line_total": line_total(),
    }


def _renewed(df: DataFrame) -> DataFrame:
    """The same columns under new ids. A union keeps its first child's, and with them projections
    that the other children lose: their plans would differ, and what they share run twice."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def _in_order(df: DataFrame, keys: dict[str, Column], order: Sequence[str]) -> DataFrame:
    """Rows sorted within their partitions, with only those hash keys that the order is by."""
    return df.withColumns({c: keys[c] for c in order if c in keys}).sortWithinPartitions(*order)


def fct_sales(
    order_items: DataFrame | list[DataFrame], orders: DataFrame, by_month: bool = False, in_order: Sequence[str] = ()
) -> DataFrame:
    """One row per order line. Items may come in parts, which meet the orders one by one.

    Items and orders meet on their integer key, and all hashes are computed last, so no hash text
    is shuffled. `by_month` spreads the joined rows by the month they will be stored under, with
    that column added: partitions come out near the advised size, and a month with most of the
    rows is split over several tasks. What staging derives from other columns is then derived
    again behind the shuffles, instead of being shuffled. `in_order` names the columns that the
    rows are to lie by within a partition: they are sorted while narrow, before the other hashes.
    """
    parts = order_items if isinstance(order_items, list) else [order_items]
    joined = reduce(DataFrame.unionByName, [_renewed(part.join(orders, "order_id")) for part in parts])
    if by_month:
        joined = joined.withColumn("order_month", F.trunc("order_date", "month")).hint(
            "rebalance", "order_month"
        )
    keys = {
        "sales_pk": surrogate_key("order_id", "item_id"),
        "dim_date_sk": surrogate_key("order_date"),
        "dim_customer_sk": keyed_nulls("customer_id"),
        "dim_product_sk": surrogate_key("product_id"),
        "dim_store_sk": surrogate_key("store_id"),
        "dim_staff_sk": surrogate_key("staff_id"),
    }
    if in_order:
        joined = _in_order(joined, keys, in_order)
    if by_month:
        joined = joined.withColumns(_derived())
    return joined.select(
        *[F.col(name) if name in in_order else key.alias(name) for name, key in keys.items()],
        "order_id",
        "item_id",
        "order_status",
        "order_status_label",
        "is_shipped",
        "order_date",
        "required_date",
        "shipped_date",
        "quantity",
        "list_price",
        "discount",
        "line_total",
        *(["order_month"] if by_month else []),
    )


def _priced(stocks: DataFrame, products: DataFrame) -> DataFrame:
    return stocks.join(products.select("product_id", "list_price"), "product_id", "left")


def _inventory(priced: DataFrame, *key: str, in_order: Sequence[str] = ()) -> DataFrame:
    keys = {
        "inventory_pk": surrogate_key(*key),
        "dim_date_sk": surrogate_key("snapshot_date"),
        "dim_store_sk": surrogate_key("store_id"),
        "dim_product_sk": surrogate_key("product_id"),
    }
    if in_order:
        priced = _in_order(priced, keys, in_order)
    return priced.select(
        *[F.col(name) if name in in_order else key.alias(name) for name, key in keys.items()],
        "store_id",
        "product_id",
        "snapshot_date",
        "quantity",
        inventory_value().alias("inventory_value"),
    )


def fct_inventory(stocks: DataFrame, products: DataFrame) -> DataFrame:
    """Store x product, newest snapshot: pass stocks of one snapshot."""
    return _inventory(_priced(stocks, products), "store_id", "product_id")


def fct_inventory_history(
    stocks: DataFrame, products: DataFrame, by_snapshot: bool = False, in_order: Sequence[str] = ()
) -> DataFrame:
    """Store x product x snapshot, so the key takes the date in. `by_snapshot` spreads the rows
    by the date they will be stored under, before any hash is computed, and a date over some
    tasks by its products: the rows get much wider in the task that hashes them. `in_order` as in
    `fct_sales`."""
    priced = _priced(stocks, products)
    if by_snapshot:
        spread = F.pmod(F.hash("product_id"), F.lit(TASKS_PER_DATE)).alias("_spread")
        priced = priced.select("*", spread).hint("rebalance", "snapshot_date", "_spread")
    return _inventory(priced, "store_id", "product_id", "snapshot_date", in_order=in_order)


def resolve_orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Point keys that have no dimension row at the missing member.

    Only the distinct keys without a parent travel, and they are few in a sound load.
    """
    orphans = (
        fact.select(key).distinct().join(dim.select(key), key, "left_anti")
        .withColumn("_orphan", F.lit(True))
    )
    resolved = F.when(F.col("_orphan"), missing_key()).otherwise(F.col(key)).alias(key)
    joined = fact.join(orphans, key, "left")
    return joined.select(*[resolved if c == key else F.col(c) for c in fact.columns])
