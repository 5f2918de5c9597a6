"""Type 1 dimensions: hash key first, one missing-member row, no history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.functions.calendar import calendar_attributes
from storelens.functions.keys import MISSING_ID, keyed_nulls, surrogate_key

# The reference's calendar.
SPINE_START = dt.date(2015, 1, 1)
SPINE_END = dt.date(2034, 12, 31)


def with_missing_member(dim: DataFrame, known: dict[str, str]) -> DataFrame:
    """Put one row in front: the missing key, `known` SQL values, NULL for the rest.

    The row comes from a range, whose size Spark knows, so the dimension keeps a usable size
    estimate for join planning.
    """
    key, *others = dim.schema.fields
    row = [f"md5('{MISSING_ID}') as {key.name}"]
    for field in others:
        kind = field.dataType.simpleString()
        row.append(f"cast({known.get(field.name, 'null')} as {kind}) as {field.name}")
    member = dim.sparkSession.range(0, 1, 1, 1).selectExpr(*row)
    return member.unionByName(dim)


def dim_customer(customers: DataFrame) -> DataFrame:
    dim = customers.select(
        surrogate_key("customer_id").alias("dim_customer_sk"),
        "customer_id",
        "first_name",
        "last_name",
        "full_name",
        "email",
        "phone",
        "street",
        "city",
        "state",
        "zip_code",
    )
    return with_missing_member(
        dim,
        {
            "customer_id": str(MISSING_ID),
            "first_name": "'Unknown'",
            "last_name": "'Unknown'",
            "full_name": "'Unknown Customer'",
        },
    )


def dim_product(products: DataFrame, brands: DataFrame, categories: DataFrame) -> DataFrame:
    """Ids come from the lookup side, so an unmatched brand or category id becomes NULL.

    No broadcast hint: Spark broadcasts a lookup that fits its threshold and sorts otherwise.
    """
    p, b, c = products.alias("p"), brands.alias("b"), categories.alias("c")
    dim = (
        p.join(b, F.col("p.brand_id") == F.col("b.brand_id"), "left")
        .join(c, F.col("p.category_id") == F.col("c.category_id"), "left")
        .select(
            surrogate_key("p.product_id").alias("dim_product_sk"),
            "p.product_id",
            "p.product_name",
            "p.model_year",
            "p.list_price",
            "b.brand_id",
            "b.brand_name",
            "c.category_id",
            "c.category_name",
        )
    )
    return with_missing_member(
        dim,
        {
            "product_id": str(MISSING_ID),
            "product_name": "'Unknown Product'",
            "brand_id": str(MISSING_ID),
            "brand_name": "'Unknown Brand'",
            "category_id": str(MISSING_ID),
            "category_name": "'Unknown Category'",
        },
    )


def dim_store(stores: DataFrame) -> DataFrame:
    dim = stores.select(
        surrogate_key("store_id").alias("dim_store_sk"),
        "store_id",
        "store_name",
        "phone",
        "email",
        "street",
        "city",
        "state",
        "zip_code",
    )
    return with_missing_member(dim, {"store_id": str(MISSING_ID), "store_name": "'Unknown Store'"})


def dim_staff(staffs: DataFrame) -> DataFrame:
    """One level of the manager hierarchy, flattened. Managers are the few distinct ids that
    occur in manager_id, so the lookup side is cut down to those before the join."""
    managers = staffs.join(
        staffs.where(F.col("manager_id").isNotNull())
        .select(F.col("manager_id").alias("staff_id"))
        .distinct(),
        "staff_id",
        "left_semi",
    ).select(
        F.col("staff_id").alias("manager_staff_id"), F.col("full_name").alias("manager_full_name")
    )
    dim = (
        staffs.join(managers, F.col("manager_id") == F.col("manager_staff_id"), "left")
        .select(
            surrogate_key("staff_id").alias("dim_staff_sk"),
            "staff_id",
            "first_name",
            "last_name",
            "full_name",
            "email",
            "phone",
            "is_active",
            "store_id",
            "manager_id",
            keyed_nulls("manager_id").alias("manager_dim_staff_sk"),
            "manager_full_name",
        )
    )
    return with_missing_member(
        dim,
        {
            "staff_id": str(MISSING_ID),
            "first_name": "'Unknown'",
            "last_name": "'Unknown'",
            "full_name": "'Unknown Staff'",
            "is_active": "false",
            "store_id": str(MISSING_ID),
            "manager_dim_staff_sk": f"md5('{MISSING_ID}')",
        },
    )


def date_spine(
    spark: SparkSession, start: dt.date = SPINE_START, end: dt.date = SPINE_END
) -> DataFrame:
    days = (end - start).days + 1
    return spark.range(0, days, 1, 1).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("date_day")
    )


def dim_date(spine: DataFrame) -> DataFrame:
    keyed = spine.select(surrogate_key("date_day").alias("dim_date_sk"), "date_day")
    dim = keyed.selectExpr("dim_date_sk", "date_day", *calendar_attributes("date_day"))
    return with_missing_member(dim, {})


def order_date_spine(orders: DataFrame) -> DataFrame:
    """The calendar of the whole years in which there are orders."""
    return (
        orders.agg(F.min("order_date").alias("first"), F.max("order_date").alias("last"))
        .select(
            F.explode(
                F.sequence(
                    F.trunc("first", "year"),
                    F.date_sub(F.add_months(F.trunc("last", "year"), 12), 1),
                )
            ).alias("date_day")
        )
    )
