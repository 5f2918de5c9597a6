"""Product, staff and customer performance dashboard."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.functions.bands import model_year_group, staff_level
from storelens.functions.keys import MISSING_ID, missing_key
from storelens.functions.numbers import MONEY_SUM, divide0, mean, money_sum, percent
from storelens.operators.periods import sum_back
from storelens.operators.ranking import dense_rank_desc, top_label
from storelens.operators.shares import total_of, whole
from storelens.plans.filters import ALL, Filters
from storelens.plans.models import Star
from storelens.plans.sales import compared, daily, revenue_by, with_date


def _with_product(fact: DataFrame, star: Star, *attributes: str | Column) -> DataFrame:
    """Line grain, for distinct order counts. A hot product key is split by the adaptive skew
    join when the dimension is too large to broadcast."""
    return fact.join(star("dim_product").select("dim_product_sk", *attributes), "dim_product_sk")


def _real_staff(star: Star, filters: Filters) -> DataFrame:
    staff = star("dim_staff").where(F.col("staff_id") != MISSING_ID)
    return staff.where("is_active") if filters.active_only else staff


def performance_kpis(star: Star, filters: Filters = ALL) -> DataFrame:
    active = F.col("is_active") & (F.col("staff_id") != MISSING_ID)
    staff = star("dim_staff").agg(F.count(F.when(active, 1))).scalar()
    discount = mean(F.sum("discount"), F.sum("lines")) * 100
    # one row per product first: the distinct count is then a plain count
    products = (
        filters.sales(star)
        .groupBy("dim_product_sk")
        .agg(F.sum("discount").alias("discount"), F.count("discount").alias("lines"))
    )
    return products.agg(
        F.count("dim_product_sk").alias("products_sold"),
        discount.alias("avg_discount_pct"),
    ).select("products_sold", staff.alias("active_staff"), "avg_discount_pct")


def performance_kpis_yoy(star: Star, filters: Filters = ALL) -> DataFrame:
    """Products sold and average discount per year, each with its value a year before.

    Lines become one row per day and product, then one per year and product, before they are
    counted: a product or a day with a third of the lines weighs no more than another.
    """
    discount = [F.sum("discount").alias("discount"), F.sum("lines").alias("lines")]
    lines = filters.sales(star, (1,)).groupBy("dim_date_sk", "dim_product_sk")
    days = with_date(
        lines.agg(F.sum("discount").alias("discount"), F.count("discount").alias("lines")),
        star, "date_day",
    )
    year = F.year("shown_date").alias("year_number")
    products = compared(star, days, filters, (1,), year, "years_back", "dim_product_sk").agg(*discount)
    sums = [F.sum(F.when(F.col("years_back") == n, F.lit(1))) for n in (0, 1)]
    rates = [mean(sum_back("discount", n), sum_back("lines", n)) * 100 for n in (0, 1)]
    return (
        products.groupBy("year_number")
        .agg(
            sums[0].alias("products_sold"), sums[1].alias("py_products_sold"),
            rates[0].alias("avg_discount_pct"), rates[1].alias("py_avg_discount_pct"),
        )
        .orderBy("year_number")
    )


def top_brand(star: Star, filters: Filters = ALL) -> DataFrame:
    brands = revenue_by(
        filters.sales(star), star("dim_product"), "dim_product_sk", ["brand_name"]
    )
    return top_label(brands, "brand_name", "revenue")


def top_staff(star: Star, filters: Filters = ALL) -> DataFrame:
    staff = revenue_by(filters.sales(star), star("dim_staff"), "dim_staff_sk", ["full_name"])
    return top_label(staff, "full_name", "revenue").withColumnRenamed("full_name", "staff_name")


def revenue_by_brand(star: Star, filters: Filters = ALL) -> DataFrame:
    """Shares are of all brands, ranks among the chosen ones. Rows, ranks and total come from one
    aggregation of the lines."""
    brands = whole(
        _with_product(replace(filters, brands=()).sales(star), star, "brand_name")
        .groupBy("brand_name")
        .agg(
            money_sum("line_total").alias("brand_revenue"),
            F.sum("quantity").alias("units_sold"),
            F.countDistinct("order_id").alias("order_count"),
        )
    )
    if filters.brands:
        total = total_of(brands, "brand_revenue")
        brands = brands.where(F.col("brand_name").isin(*filters.brands))
        ranked = dense_rank_desc(brands, "brand_revenue", "revenue_rank")
    else:
        total = F.col("_total")
        ranked = dense_rank_desc(brands, "brand_revenue", "revenue_rank", "_total")
    share = divide0(F.col("brand_revenue"), total) * 100
    shown = ranked.withColumn("share_pct", share).drop("_total")
    return shown.orderBy(F.desc("brand_revenue"), "brand_name")


def revenue_by_model_year(star: Star, filters: Filters = ALL) -> DataFrame:
    return (
        _with_product(filters.sales(star), star, "model_year")
        .where(F.col("model_year").isNotNull())
        .groupBy("model_year")
        .agg(
            money_sum("line_total").alias("revenue"),
            F.sum("quantity").alias("units_sold"),
            F.countDistinct("order_id").alias("orders"),
        )
        .orderBy("model_year")
    )


def revenue_by_model_year_group(star: Star, filters: Filters = ALL) -> DataFrame:
    products = star("dim_product").select(
        "dim_product_sk", model_year_group(F.col("model_year")).alias("model_year_group")
    )
    return revenue_by(
        filters.sales(star), products, "dim_product_sk", ["model_year_group"],
        "revenue", "units_sold",
    )


def category_revenue_share(star: Star, filters: Filters = ALL) -> DataFrame:
    """Shares are of all categories, whichever are chosen."""
    groups = revenue_by(
        replace(filters, categories=()).sales(star),
        star("dim_product"), "dim_product_sk", ["category_name"],
    ).withColumnRenamed("revenue", "category_revenue")
    share = percent(F.col("category_revenue"), total_of(groups, "category_revenue"))
    shares = groups.withColumn("revenue_pct", share)
    if filters.categories:
        shares = shares.where(F.col("category_name").isin(*filters.categories))
    return shares.orderBy(
        F.desc("category_revenue"), "category_name"
    )


def avg_discount_by_category(star: Star, filters: Filters = ALL) -> DataFrame:
    return (
        _with_product(filters.sales(star), star, "category_name")
        .groupBy("category_name")
        .agg(
            mean(F.sum("discount"), F.count("discount")).alias("avg_discount_rate"),
            F.countDistinct("order_id").alias("orders"),
        )
        .withColumn("avg_discount_pct", F.col("avg_discount_rate") * 100)
        .orderBy(F.desc("avg_discount_rate"), "category_name")
    )


def _per_key_with_orders(fact: DataFrame, key: str) -> DataFrame:
    """Revenue and distinct orders per staff member or customer. Spark counts distinct orders
    on (key, order) first, so one key's orders are spread over all tasks."""
    return fact.groupBy(key).agg(
        money_sum("line_total").alias("revenue"), F.countDistinct("order_id").alias("orders")
    )


def staff_leaderboard(star: Star, filters: Filters = ALL) -> DataFrame:
    """Staff by revenue, with their own store and manager."""
    staff = _real_staff(star, filters).select(
        "dim_staff_sk",
        "staff_id",
        F.col("full_name").alias("staff_name"),
        "manager_full_name",
        "is_active",
        "store_id",
    )
    stores = star("dim_store").select("store_id", "store_name")
    rows = (
        _per_key_with_orders(filters.sales(star), "dim_staff_sk")
        .join(staff, "dim_staff_sk")
        .join(stores, "store_id")
        .select(
            "staff_id",
            "staff_name",
            "manager_full_name",
            "store_name",
            "is_active",
            F.col("orders").alias("orders_handled"),
            "revenue",
            divide0(F.col("revenue"), F.col("orders")).alias("avg_order_value"),
        )
    )
    return dense_rank_desc(rows, "revenue", "revenue_rank").orderBy(
        F.desc("revenue"), "staff_id"
    )


def top_customers(star: Star, filters: Filters = ALL, n: int = 10) -> DataFrame:
    """Guests are one row: their orders all carry the missing customer's key."""
    names = ["customer_name", "city", "state"]
    customers = star("dim_customer").select(
        "dim_customer_sk", F.col("full_name").alias("customer_name"), "city", "state"
    )
    return (
        _per_key_with_orders(filters.sales(star), "dim_customer_sk")
        .join(customers, "dim_customer_sk")
        .groupBy(*names)
        .agg(
            F.sum("orders").alias("orders"),
            F.sum("revenue").cast(MONEY_SUM).alias("revenue"),
        )
        .orderBy(F.desc("revenue"), *[F.asc_nulls_last(c) for c in names])
        .limit(n)
    )


def repeat_customers(star: Star, filters: Filters = ALL) -> DataFrame:
    """Registered customers with more than one order."""
    customers = star("dim_customer").select(
        "dim_customer_sk", "customer_id", F.col("full_name").alias("customer_name")
    )
    registered = filters.sales(star).where(F.col("dim_customer_sk") != missing_key())
    return (
        _per_key_with_orders(registered, "dim_customer_sk")
        .where(F.col("orders") > 1)
        .join(customers, "dim_customer_sk")
        .select("customer_id", "customer_name", "orders", "revenue")
        .orderBy(F.desc("revenue"), "customer_id")
    )


def guest_revenue(star: Star, filters: Filters = ALL) -> DataFrame:
    kind = F.when(F.col("dim_customer_sk") == missing_key(), "Guest").otherwise("Registered")
    return _per_key_with_orders(
        filters.sales(star).withColumn("customer_type", kind), "customer_type"
    ).select("customer_type", "orders", "revenue")


def discount_yoy(star: Star, filters: Filters = ALL) -> DataFrame:
    days = daily(
        star,
        filters,
        (1,),
        F.sum("discount").alias("discount"),
        F.count("discount").alias("lines"),
    )
    keys = [
        F.year("shown_date").alias("year_number"),
        F.month("shown_date").alias("month_number"),
    ]
    now, before = [mean(sum_back("discount", n), sum_back("lines", n)) * 100 for n in (0, 1)]
    return (
        compared(star, days, filters, (1,), *keys)
        .agg(now.alias("avg_discount_pct"), before.alias("py_avg_discount_pct"))
        .select(
            "year_number",
            "month_number",
            "avg_discount_pct",
            "py_avg_discount_pct",
            (F.col("avg_discount_pct") - F.col("py_avg_discount_pct")).alias("change_pp"),
        )
        .orderBy("year_number", "month_number")
    )


def staff_levels(star: Star) -> DataFrame:
    level = staff_level(F.col("manager_id")).alias("staff_level")
    return star("dim_staff").select("staff_id", "full_name", level)


def manager_rollup(star: Star, filters: Filters = ALL) -> DataFrame:
    """Sales of the staff below each manager. Staff without a manager come under the missing
    member."""
    staff = star("dim_staff")
    managers = staff.select(
        F.col("dim_staff_sk").alias("manager_dim_staff_sk"),
        F.col("staff_id").alias("manager_id"),
        F.col("full_name").alias("manager_name"),
    )
    return (
        _per_key_with_orders(filters.sales(star), "dim_staff_sk")
        .join(staff.select("dim_staff_sk", "manager_dim_staff_sk"), "dim_staff_sk")
        .groupBy("manager_dim_staff_sk")
        .agg(
            F.count(F.lit(1)).alias("selling_staff"),
            F.sum("orders").alias("orders"),
            F.sum("revenue").cast(MONEY_SUM).alias("revenue"),
        )
        .join(managers, "manager_dim_staff_sk")
        .select("manager_id", "manager_name", "selling_staff", "orders", "revenue")
        .orderBy(F.desc("revenue"), "manager_id")
    )
