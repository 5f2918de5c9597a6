"""Sales dashboard.

Additive measures are summed per dimension key before the fact meets the dimension: the partial
sums are made where the rows are read, so a key that holds a third of the rows sends as little as
any other, and the join sees one row per key. Only distinct order counts per product attribute
need the join at line grain.

An order has one date, store, customer and staff member, because order_id is unique in orders
(a tested constraint); order counts per such a key therefore add up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.functions.bands import revenue_band
from storelens.functions.calendar import month_year_label, quarter_year_label
from storelens.functions.numbers import MONEY_SUM, divide0, mean, money_sum, percent, ratio
from storelens.operators.periods import shown_on, sum_back
from storelens.operators.ranking import dense_rank_desc
from storelens.operators.shares import total_of
from storelens.plans.filters import ALL, Filters
from storelens.plans.models import Star

OFFSETS = (1, 2, 3)


def revenue_per(fact: DataFrame, *keys: str | Column) -> DataFrame:
    return fact.groupBy(*keys).agg(
        money_sum("line_total").alias("revenue"), F.sum("quantity").alias("units_sold")
    )


def revenue_by(
    fact: DataFrame, dim: DataFrame, key: str, names: list[str], *measures: str
) -> DataFrame:
    """Sums per attribute of a dimension, by way of sums per its key."""
    return (
        revenue_per(fact, key)
        .join(dim.select(key, *names), key)
        .groupBy(*names)
        .agg(*[_resum(m) for m in measures or ("revenue",)])
    )


def _resum(measure: str) -> Column:
    total = F.sum(measure)
    return (total.cast(MONEY_SUM) if measure == "revenue" else total).alias(measure)


def with_date(fact: DataFrame, star: Star, *attributes: str) -> DataFrame:
    """The calendar is bounded by its range of days, hence the broadcast."""
    calendar = star("dim_date").select("dim_date_sk", *attributes)
    return fact.join(F.broadcast(calendar), "dim_date_sk")


def orders_of(fact: DataFrame, *keys: str) -> DataFrame:
    """One row per order: distinct order counts become plain counts."""
    return fact.groupBy(*keys, "order_id").agg(
        money_sum("line_total").alias("revenue"),
        F.sum("quantity").alias("units_sold"),
        F.max("is_shipped").alias("is_shipped"),
    )


def _kpi_sums() -> list[Column]:
    shipped = F.when(F.col("is_shipped"), F.col("order_id"))
    return [
        F.sum("revenue").cast(MONEY_SUM).alias("total_revenue"),
        F.count("order_id").alias("total_orders"),
        F.sum("units_sold").alias("units_sold"),
        F.count(shipped).alias("shipped_orders"),
    ]


def _kpi_ratios() -> dict[str, Column]:
    orders = F.col("total_orders")
    return {
        "avg_order_value": divide0(F.col("total_revenue"), orders),
        "fulfillment_rate_pct": divide0(F.col("shipped_orders"), orders) * 100,
    }


KPIS = [
    "total_revenue",
    "total_orders",
    "avg_order_value",
    "units_sold",
    "fulfillment_rate_pct",
]


def sales_kpis(star: Star, filters: Filters = ALL) -> DataFrame:
    totals = orders_of(filters.sales(star)).agg(*_kpi_sums())
    return totals.withColumns(_kpi_ratios()).select(*KPIS)


def revenue_trend_monthly(star: Star, filters: Filters = ALL) -> DataFrame:
    month = ["year_number", "month_number", "month_name"]
    return (
        with_date(filters.sales(star), star, *month)
        .groupBy(*month)
        .agg(money_sum("line_total").alias("monthly_revenue"))
        .orderBy("year_number", "month_number")
    )


def order_status_distribution(star: Star, filters: Filters = ALL) -> DataFrame:
    groups = (
        filters.sales(star)
        .groupBy("order_status", "order_status_label")
        .agg(F.countDistinct("order_id").alias("order_count"))
    )
    share = percent(F.col("order_count"), total_of(groups, "order_count"))
    return groups.withColumn("pct", share).orderBy("order_status")


def orders_by_status_measures(star: Star, filters: Filters = ALL) -> DataFrame:
    measures = {"completed": 4, "pending": 1, "rejected": 3, "processing": 2}
    orders = (
        filters.sales(star)
        .groupBy("order_id")
        .agg(*[F.max(F.col("order_status") == code).alias(m) for m, code in measures.items()])
    )
    return orders.agg(
        *[F.count(F.when(F.col(m), F.col("order_id"))).alias(f"{m}_orders") for m in measures]
    )


def revenue_by_store(star: Star, filters: Filters = ALL) -> DataFrame:
    groups = revenue_by(filters.sales(star), star("dim_store"), "dim_store_sk", ["store_name"])
    return groups.withColumnRenamed("revenue", "store_revenue").orderBy(
        F.desc("store_revenue"), "store_name"
    )


def revenue_by_category(star: Star, filters: Filters = ALL) -> DataFrame:
    groups = revenue_by(
        filters.sales(star), star("dim_product"), "dim_product_sk", ["category_name"]
    )
    return groups.withColumnRenamed("revenue", "category_revenue").orderBy(
        F.desc("category_revenue"), "category_name"
    )


def top_products(star: Star, filters: Filters = ALL, n: int = 10) -> DataFrame:
    names = ["product_name", "brand_name", "category_name"]
    groups = revenue_by(
        filters.sales(star), star("dim_product"), "dim_product_sk", names,
        "units_sold", "revenue",
    )
    price = ratio(F.col("revenue"), F.col("units_sold"))
    return (
        groups.withColumn("avg_selling_price", price)
        .orderBy(F.desc("revenue"), *names)
        .limit(n)
    )


def monthly_summary(star: Star, filters: Filters = ALL) -> DataFrame:
    month = ["year_number", "month_number", "month_name"]
    groups = (
        with_date(filters.sales(star), star, *month)
        .groupBy(*month)
        .agg(
            money_sum("line_total").alias("revenue"),
            F.countDistinct("order_id").alias("orders"),
            mean(F.sum("discount"), F.count("discount")).alias("avg_discount"),
        )
    )
    return groups.withColumn("avg_discount_pct", F.col("avg_discount") * 100).orderBy(
        "year_number", "month_number"
    )


def daily(star: Star, filters: Filters, years_back: tuple[int, ...], *sums: Column) -> DataFrame:
    """Sums per calendar day, over the period and the earlier ones it is compared with."""
    days = filters.sales(star, years_back).groupBy("dim_date_sk").agg(*sums)
    return with_date(days, star, "date_day")


def compared(
    star: Star, days: DataFrame, filters: Filters, years_back: tuple[int, ...], *keys: Column
) -> DataFrame:
    """Daily rows under their own and their shifted dates, grouped for `sum_back`.

    A period shows if it or the one it is compared with has rows, as long as it is in the
    calendar: one that fell to nothing keeps its earlier value.
    """
    shown = shown_on(days, "date_day", years_back)
    shown = shown.where(F.col("shown_date") <= F.lit(star.spine[1]))
    period = filters.period(F.col("shown_date"))
    return (shown if period is None else shown.where(period)).groupBy(*keys)


def _month_keys() -> list[Column]:
    return [
        F.year("shown_date").alias("year_number"),
        F.month("shown_date").alias("month_number"),
    ]


def _revenue_back(star: Star, filters: Filters, years_back: tuple[int, ...]) -> DataFrame:
    """Months with the revenue of the same month in earlier years; NULL where there is none."""
    days = daily(star, filters, years_back, money_sum("line_total").alias("revenue"))
    return compared(star, days, filters, years_back, *_month_keys()).agg(
        *[
            sum_back("revenue", n).cast(MONEY_SUM).alias(f"revenue_{n}")
            for n in (0, *years_back)
        ],
    )


def revenue_yoy(star: Star, filters: Filters = ALL) -> DataFrame:
    revenue, before = F.col("revenue_0"), F.col("revenue_1")
    return (
        _revenue_back(star, filters, (1,))
        .select(
            "year_number",
            "month_number",
            revenue.alias("revenue"),
            before.alias("py_revenue"),
            (divide0(F.coalesce(revenue, F.lit(0)) - before, before) * 100).alias("yoy_growth_pct"),
        )
        .orderBy("year_number", "month_number")
    )


def revenue_n_years_ago(
    star: Star, filters: Filters = ALL, offsets: tuple[int, ...] = OFFSETS
) -> DataFrame:
    """One row per month and offset with revenue in either of the two months."""
    rows = [
        F.struct(F.lit(n).alias("years_back"), F.col(f"revenue_{n}").alias("earlier_revenue"))
        for n in offsets
    ]
    return (
        _revenue_back(star, filters, offsets)
        .select(
            "year_number",
            "month_number",
            F.col("revenue_0").alias("revenue"),
            F.inline(F.array(*rows)),
        )
        .where(F.col("revenue").isNotNull() | F.col("earlier_revenue").isNotNull())
        .orderBy("year_number", "month_number", "years_back")
    )


def kpis_yoy(star: Star, filters: Filters = ALL) -> DataFrame:
    """The KPI cards per year, each with its value a year before and the change in percent."""
    orders = orders_of(filters.sales(star, (1,)), "dim_date_sk")
    days = with_date(orders.groupBy("dim_date_sk").agg(*_kpi_sums()), star, "date_day")
    sums = ["total_revenue", "total_orders", "units_sold", "shipped_orders"]
    years = compared(star, days, filters, (1,), F.year("shown_date").alias("year_number")).agg(
        *[
            sum_back(m, n).cast(days.schema[m].dataType).alias(f"{m}_{n}")
            for m in sums
            for n in (0, 1)
        ],
    )

    def divided(a: str, b: str) -> str:
        return f"coalesce(try_divide(double({a}), double({b})), 0D)"

    ratios = []
    for n in (0, 1):
        orders_n = f"total_orders_{n}"
        value = divided(f"total_revenue_{n}", orders_n)
        rate = f"{divided(f'shipped_orders_{n}', orders_n)} * 100"
        ratios += [
            f"if({orders_n} is null, null, {value}) as avg_order_value_{n}",
            f"if({orders_n} is null, null, {rate}) as fulfillment_rate_pct_{n}",
        ]
    columns = ["year_number"]
    for m in KPIS:
        change = divided(f"coalesce(double({m}_0), 0D) - double({m}_1)", f"{m}_1")
        columns += [f"{m}_0 as {m}", f"{m}_1 as py_{m}", f"{change} * 100 as {m}_change_pct"]
    return (
        years.selectExpr("*", *ratios)
        .selectExpr(*columns)
        .orderBy("year_number")
    )


SHARE_OF = {
    "store": ("dim_store", "store_name"),
    "product": ("dim_product", "product_name"),
    "category": ("dim_product", "category_name"),
    "brand": ("dim_product", "brand_name"),
}


def revenue_share(star: Star, by: str, filters: Filters = ALL) -> DataFrame:
    """Revenue of each store, product, category or brand against that of all stores and
    products in the same period."""
    dim, name = SHARE_OF[by]
    key = f"{dim}_sk"
    # the join below asks for this too; said here, the total has the same plan and shares its shuffle
    sales = filters.sales(star).where(F.col(key).isNotNull())
    per_key = sales.groupBy(key).agg(money_sum("line_total").alias("revenue"))
    if filters.without_entities() == filters:
        total = total_of(per_key, "revenue")
    else:
        everything = filters.without_entities().sales(star)
        total = everything.agg(money_sum("line_total").alias("revenue")).scalar()
    groups = (
        per_key.join(star(dim).select(key, F.col(name).alias("name")), key)
        .groupBy("name")
        .agg(_resum("revenue"))
    )
    share = divide0(F.col("revenue"), total) * 100
    return groups.select(F.lit(by).alias("by"), "name", "revenue", share.alias("share_pct"))


def revenue_rank_products(star: Star, filters: Filters = ALL) -> DataFrame:
    groups = revenue_by(
        filters.sales(star), star("dim_product"), "dim_product_sk", ["product_name"]
    )
    return dense_rank_desc(groups, "revenue", "revenue_rank")


def revenue_bands(star: Star, filters: Filters = ALL) -> DataFrame:
    return (
        filters.sales(star)
        .groupBy(revenue_band("line_total").alias("band"))
        .agg(F.count(F.lit(1)).alias("lines"), money_sum("line_total").alias("revenue"))
    )


def revenue_by_quarter(star: Star, filters: Filters = ALL) -> DataFrame:
    quarter = ["year_number", "quarter_number"]
    label = quarter_year_label(F.col("year_number"), F.col("quarter_number"))
    return (
        with_date(filters.sales(star), star, *quarter)
        .groupBy(*quarter)
        .agg(money_sum("line_total").alias("revenue"))
        .orderBy(*quarter)
        .select(label.alias("quarter_year_label"), "revenue")
    )


def revenue_by_month_label(star: Star, filters: Filters = ALL) -> DataFrame:
    first_day = F.trunc("date_day", "month").alias("month")
    days = with_date(filters.sales(star), star, "date_day")
    return (
        days.groupBy(first_day)
        .agg(money_sum("line_total").alias("revenue"))
        .orderBy("month")
        .select(month_year_label(F.col("month")).alias("month_year_label"), "revenue")
    )


def discount_percent(star: Star, filters: Filters = ALL) -> DataFrame:
    """Per order line, as a column: no aggregation."""
    share = (F.col("discount") * 100).cast("decimal(6,2)")
    return filters.sales(star).select(
        "order_id", "item_id", "discount", share.alias("discount_pct")
    )
