"""Cleaning, one function per source table. Each is a pure projection: no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.functions.bands import order_status_label
from storelens.functions.numbers import line_total
from storelens.functions.text import blank_to_null, full_name, lowered, trimmed, uppered


def stg_customers(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "customer_id",
        trimmed("first_name"),
        trimmed("last_name"),
        full_name(),
        lowered("email"),
        blank_to_null("phone"),
        blank_to_null("street"),
        blank_to_null("city"),
        uppered("state"),
        blank_to_null("zip_code"),
    )


def stg_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        "customer_id",
        "order_status",
        order_status_label("order_status").alias("order_status_label"),
        "order_date",
        "required_date",
        "shipped_date",
        F.col("shipped_date").isNotNull().alias("is_shipped"),
        "store_id",
        "staff_id",
    )


def stg_order_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        "item_id",
        "product_id",
        "quantity",
        "list_price",
        "discount",
        line_total().alias("line_total"),
    )


def stg_staffs(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "staff_id",
        trimmed("first_name"),
        trimmed("last_name"),
        full_name(),
        lowered("email"),
        blank_to_null("phone"),
        "active = 1 as is_active",
        "store_id",
        "manager_id",
    )


def stg_stores(raw: DataFrame) -> DataFrame:
    """The store's email is kept in its own case."""
    return raw.selectExpr(
        "store_id",
        trimmed("store_name"),
        blank_to_null("phone"),
        blank_to_null("email"),
        blank_to_null("street"),
        blank_to_null("city"),
        uppered("state"),
        blank_to_null("zip_code"),
    )


def stg_brands(raw: DataFrame) -> DataFrame:
    return raw.selectExpr("brand_id", trimmed("brand_name"))


def stg_categories(raw: DataFrame) -> DataFrame:
    return raw.selectExpr("category_id", trimmed("category_name"))


def stg_products(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "product_id",
        trimmed("product_name"),
        "brand_id",
        "category_id",
        "model_year",
        "list_price",
    )


def stg_stocks(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "store_id",
        "product_id",
        "coalesce(quantity, 0) as quantity",
        "ingestion_date as snapshot_date",
    )


STAGING = {
    "customers": stg_customers,
    "orders": stg_orders,
    "order_items": stg_order_items,
    "staffs": stg_staffs,
    "stores": stg_stores,
    "brands": stg_brands,
    "categories": stg_categories,
    "products": stg_products,
    "stocks": stg_stocks,
}
