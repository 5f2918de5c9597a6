"""Every query by name, run over a folder of driver tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.functions.keys import keyed_nulls, missing_key, surrogate_key
from storelens.operators.dimensions import dim_date, order_date_spine
from storelens.operators.loads import latest_full_load
from storelens.operators.quality import run_checks
from storelens.operators.staging import STAGING
from storelens.plans import inventory, performance, sales
from storelens.plans.filters import Filters
from storelens.plans.models import GOLD, LandedTables, Star, StoredStar
from storelens.plans.suite import COMPOSITE_UNIQUE, SUITE, only
from storelens.plans.warehouse import (
    BUILD_ORDER,
    build_warehouse,
    ingest,
    landed_catalog,
    publish_model,
    write_model,
)
from storelens.session import scratch_path
from storelens.sources import raw
from storelens.sources.driver_tables import SNAPSHOT_START, SNAPSHOTS, DriverTables
from storelens.sources.jdbc import base_tables
from storelens.sources.schemas import PRODUCTION_TABLES, SALES_TABLES, TABLES, SourceTable
from storelens.streaming.snapshots import STOCKS, read_history, snapshot_stream

Query = Callable[[SparkSession, str], DataFrame]

# The inputs' orders lie before the default calendar.
SPINE = {"spine_start": dt.date(1995, 1, 1), "spine_end": dt.date(2034, 12, 31)}
DAYS = [SNAPSHOT_START + dt.timedelta(days=k) for k in range(SNAPSHOTS)]


def star_of(spark: SparkSession, folder: str) -> Star:
    return Star(DriverTables(spark, folder), **SPINE)


def on_star(query: Callable[..., DataFrame], *args, **kwargs) -> Query:
    return lambda spark, folder: query(star_of(spark, folder), *args, **kwargs)


def on_sources(query: Callable[[DriverTables], DataFrame]) -> Query:
    return lambda spark, folder: query(DriverTables(spark, folder))


def model(name: str) -> Query:
    return on_star(lambda star: star(name))


def checks(selected: list) -> Query:
    return on_star(lambda star: run_checks(star, selected))


def all_shares(star: Star) -> DataFrame:
    return reduce(DataFrame.unionByName, [sales.revenue_share(star, by) for by in sales.SHARE_OF])


def _land(tables: list[SourceTable]) -> Query:
    """Land one load of each table, then show what the manifest says of it."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        sources, root = DriverTables(spark, folder), scratch_path(spark, "ingest")
        load = raw.Load(DAYS[-1], "first")
        ingest(lambda table: sources.latest(table.name), tables, root, load)
        return raw.read_manifest(spark, root).drop(
            "run_id", "path", "duration_seconds", "loaded_at", "schema_changes"
        )

    return run


def land_stocks(sources: DriverTables, root: str) -> None:
    """Every snapshot date of stocks as a load of its own, the last one twice."""
    history = sources.history("stocks")
    for i, day in enumerate([*DAYS, DAYS[-1]]):
        snapshot = history.where(F.col("ingestion_date") == F.lit(day))
        raw.write_snapshot(snapshot, root, STOCKS, raw.Load(day, f"run{i}"))


def manifest_reconciliation(sources: DriverTables) -> DataFrame:
    """Land all tables, and stocks of every date, and compare the manifest with what is there."""
    root, tables = scratch_path(sources.spark, "reconciled"), [*SALES_TABLES, *PRODUCTION_TABLES]
    others = [t for t in tables if t is not STOCKS]
    ingest(lambda table: sources.latest(table.name), others, root, raw.Load(DAYS[-1], "first"))
    land_stocks(sources, root)
    return raw.reconcile(sources.spark, root, tables)


def raw_snapshot_write(sources: DriverTables) -> DataFrame:
    """Write a snapshot twice under one load and read it back: the rerun replaces it."""
    root, table = scratch_path(sources.spark, "snapshot"), TABLES["customers"]
    load = raw.Load(DAYS[0], "first")
    for _ in range(2):
        raw.write_snapshot(sources.latest(table.name), root, table, load)
    return table.conform(raw.scan(sources.spark, root, table))


def raw_scan(sources: DriverTables) -> DataFrame:
    root = scratch_path(sources.spark, "raw")
    land_stocks(sources, root)
    return LandedTables(sources.spark, root).history("stocks").drop("run_id")


def source_catalog(sources: DriverTables) -> DataFrame:
    root = scratch_path(sources.spark, "catalog")
    tables = [*SALES_TABLES, *PRODUCTION_TABLES]
    ingest(lambda table: sources.latest(table.name), tables, root)
    listed = base_tables(landed_catalog(sources.spark, root))
    landed = raw.read_manifest(sources.spark, root).select(
        F.col("schema").alias("table_schema"), F.col("table").alias("table_name"), "row_count"
    )
    return listed.join(landed, ["table_schema", "table_name"])


def model_write(star: Star) -> DataFrame:
    root, name = scratch_path(star.spark, "model"), "fct_sales"
    publish_model(star.spark, root, name, write_model(star.laid_out(name), root, name))
    stored = StoredStar(star.sources, root, **SPINE)
    return stored("fct_sales").select(*star("fct_sales").columns)


def on_stored_facts(query: Callable[..., DataFrame], filters: Filters) -> Callable[[Star], DataFrame]:
    """Write the sales fact in its stored layout and query it with the filter's keys as lists."""

    def run(star: Star) -> DataFrame:
        root, name = scratch_path(star.spark, "facts"), "fct_sales"
        publish_model(star.spark, root, name, write_model(star.laid_out(name), root, name))
        return query(MixedStar(star, StoredStar(star.sources, root, **SPINE), (name,)), filters.resolved(star))

    return run


class MixedStar(Star):
    """Some models as they are stored, the others computed."""

    def __init__(self, computed: Star, stored: StoredStar, names: tuple[str, ...]):
        super().__init__(computed.sources, *computed.spine)
        self._of = {name: stored for name in names}
        self._computed = computed

    def _build(self, name: str) -> DataFrame:
        return self._of.get(name, self._computed)(name)


def warehouse(sources: DriverTables, check: bool = False) -> StoredStar:
    return build_warehouse(sources, scratch_path(sources.spark, "warehouse"), check, **SPINE)


def model_rows(sources: DriverTables) -> DataFrame:
    """Build the warehouse with its checks and count the rows of every model."""
    stored = warehouse(sources, check=True)
    counts = [
        stored(name).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("model"), "row_count"
        )
        for name in BUILD_ORDER
    ]
    return reduce(DataFrame.unionByName, counts)


def missing_members(star: Star) -> DataFrame:
    counts = []
    for name in (n for n in GOLD if n.startswith("dim_")):
        missing = F.when(F.col(f"{name}_sk") == missing_key(), 1)
        counts.append(
            star(name).agg(
                F.lit(name).alias("dimension"),
                F.count(F.lit(1)).alias("members"),
                F.count(missing).alias("missing_members"),
            )
        )
    return reduce(DataFrame.unionByName, counts)


def keys_of_lines(sources: DriverTables) -> DataFrame:
    return sources.latest("order_items").select(
        "order_id",
        "item_id",
        surrogate_key("order_id", "item_id").alias("sales_pk"),
        surrogate_key("product_id").alias("dim_product_sk"),
    )


def keys_of_customers(sources: DriverTables) -> DataFrame:
    return sources.latest("orders").select(
        "order_id",
        "customer_id",
        keyed_nulls("customer_id").alias("dim_customer_sk"),
        surrogate_key("customer_id").alias("unkeyed_sk"),
    )


def streamed_history(sources: DriverTables) -> DataFrame:
    """Land the first snapshot, stream; land all and a further one, stream; empty that, stream."""
    spark = sources.spark
    root, target, state = (scratch_path(spark, f"stream-{s}") for s in ("raw", "out", "state"))
    products = STAGING["products"](sources.latest("products"))
    first = sources.history("stocks").where(F.col("ingestion_date") == F.lit(DAYS[0]))
    raw.write_snapshot(first, root, STOCKS, raw.Load(DAYS[0], "early"))
    snapshot_stream(spark, root, products, target, state).awaitTermination()
    land_stocks(sources, root)
    # a further day that is filled at first and empty when it is loaded again
    later = DAYS[-1] + dt.timedelta(days=1)
    raw.write_snapshot(first, root, STOCKS, raw.Load(later, "filled"))
    snapshot_stream(spark, root, products, target, state).awaitTermination()
    raw.write_snapshot(first.limit(0), root, STOCKS, raw.Load(later, "emptied"))
    snapshot_stream(spark, root, products, target, state).awaitTermination()
    return read_history(spark, target)


INGEST: dict[str, Query] = {
    "jdbc_full_load": on_sources(lambda sources: sources.latest("orders")),
    "source_catalog": on_sources(source_catalog),
    "ingest_sales": _land(SALES_TABLES),
    "ingest_production": _land(PRODUCTION_TABLES),
    "ingest_manifest": _land([*SALES_TABLES, *PRODUCTION_TABLES]),
    "manifest_reconciliation": on_sources(manifest_reconciliation),
    "raw_snapshot_write": on_sources(raw_snapshot_write),
    "raw_scan": on_sources(raw_scan),
    "model_write": on_star(model_write),
    "build_warehouse": on_sources(model_rows),
}

KEYS: dict[str, Query] = {
    "latest_full_load": on_sources(lambda sources: latest_full_load(sources.history("stocks"))),
    "surrogate_key": on_sources(keys_of_lines),
    "keyed_nulls": on_sources(keys_of_customers),
    "missing_member": on_star(missing_members),
}

MODELS: dict[str, Query] = {
    **{f"stg_{name}": model(f"stg_{name}") for name in STAGING},
    **{name: model(name) for name in GOLD},
    "dim_date": on_star(lambda star: dim_date(order_date_spine(star("stg_orders")))),
}

QUALITY: dict[str, Query] = {
    "dq_unique": checks(only("unique")),
    "dq_not_null": checks(only("not_null")),
    "dq_accepted_values": checks(only("accepted_values")),
    "dq_relationships": checks(only("relationships")),
    "dq_suite": on_sources(lambda sources: run_checks(warehouse(sources), SUITE)),
    "dq_composite_unique": checks(COMPOSITE_UNIQUE),
}

SALES: dict[str, Query] = {
    "sales_kpis": on_star(sales.sales_kpis),
    "revenue_trend_monthly": on_star(sales.revenue_trend_monthly),
    "order_status_distribution": on_star(sales.order_status_distribution),
    "orders_by_status_measures": on_star(sales.orders_by_status_measures),
    "revenue_by_store": on_star(sales.revenue_by_store),
    "revenue_by_category": on_star(sales.revenue_by_category),
    "top_products": on_star(sales.top_products),
    "monthly_summary": on_star(sales.monthly_summary),
    "revenue_yoy": on_star(sales.revenue_yoy),
    "revenue_n_years_ago": on_star(sales.revenue_n_years_ago),
    "kpis_yoy": on_star(sales.kpis_yoy),
    "revenue_share": on_star(all_shares),
    "revenue_rank_products": on_star(sales.revenue_rank_products),
    "revenue_bands": on_star(sales.revenue_bands),
    "revenue_by_quarter": on_star(sales.revenue_by_quarter),
    "revenue_by_month_label": on_star(sales.revenue_by_month_label),
    "discount_percent": on_star(sales.discount_percent),
}

INVENTORY: dict[str, Query] = {
    "inventory_kpis": on_star(inventory.inventory_kpis),
    "inventory_value_by_store": on_star(inventory.inventory_value_by_store),
    "units_by_store": on_star(inventory.units_by_store),
    "inventory_trend": on_star(inventory.inventory_trend),
    "units_by_category": on_star(inventory.units_by_category),
    "inventory_value_by_brand": on_star(inventory.inventory_value_by_brand),
    "low_stock_alerts": on_star(inventory.low_stock_alerts),
    "alert_level_counts": on_star(inventory.alert_level_counts),
    "low_stock_by_threshold": on_star(inventory.low_stock_by_threshold),
    "snapshot_dates": on_star(inventory.snapshot_dates),
    "snapshot_change": on_star(inventory.snapshot_change),
    "snapshot_as_of": on_star(inventory.snapshot_as_of, DAYS[1]),
    "store_inventory_share": on_star(inventory.store_inventory_share),
    "is_low_stock": on_star(inventory.is_low_stock_rows),
    "low_stock_products": on_star(inventory.low_stock_products),
    "days_of_supply": on_star(inventory.days_of_supply),
}

PERFORMANCE: dict[str, Query] = {
    "performance_kpis": on_star(performance.performance_kpis),
    "performance_kpis_yoy": on_star(performance.performance_kpis_yoy),
    "top_brand": on_star(performance.top_brand),
    "top_staff": on_star(performance.top_staff),
    "revenue_by_brand": on_star(performance.revenue_by_brand),
    "revenue_by_model_year": on_star(performance.revenue_by_model_year),
    "revenue_by_model_year_group": on_star(performance.revenue_by_model_year_group),
    "category_revenue_share": on_star(performance.category_revenue_share),
    "avg_discount_by_category": on_star(performance.avg_discount_by_category),
    "staff_leaderboard": on_star(performance.staff_leaderboard),
    "top_customers": on_star(performance.top_customers),
    "repeat_customers": on_star(performance.repeat_customers),
    "guest_revenue": on_star(performance.guest_revenue),
    "discount_yoy": on_star(performance.discount_yoy),
    "staff_level": on_star(performance.staff_levels),
    "manager_rollup": on_star(performance.manager_rollup),
}

FILTERS: dict[str, Query] = {
    "filter_period": on_star(
        sales.revenue_trend_monthly, Filters(years=(1997,), quarters=(1, 4))
    ),
    "filter_store": on_star(sales.sales_kpis, Filters(stores=("ASIA Store", "EUROPE Store"))),
    "filter_category": on_star(sales.sales_kpis, Filters(categories=("STANDARD", "PROMO"))),
    "filter_brand": on_star(sales.sales_kpis, Filters(brands=("Brand#11", "Brand#23"))),
    "filter_status": on_star(sales.sales_kpis, Filters(statuses=("Completed",))),
    "filter_staff": on_star(
        sales.sales_kpis,
        Filters(
            staff=("First1 Last1", "First2 Last2"), stores=("ASIA Store",), store_scope="staff"
        ),
    ),
    "filter_snapshot": on_star(inventory.units_by_store, Filters(snapshot=DAYS[0])),
    "filter_threshold": on_star(inventory.low_stock_alerts, Filters(threshold=12)),
    "filter_date_range": on_star(
        sales.revenue_trend_monthly,
        Filters(start=dt.date(1996, 3, 15), end=dt.date(1997, 2, 10)),
    ),
    "filter_since": on_star(
        sales.revenue_trend_monthly, Filters(start=dt.date(1998, 2, 1))
    ),
    "filter_until": on_star(sales.revenue_trend_monthly, Filters(end=dt.date(1995, 6, 30))),
    "filter_quarter": on_star(sales.revenue_trend_monthly, Filters(quarters=(2,))),
    "filter_first_load": on_star(sales.sales_kpis, Filters.first_load(dt.date(1997, 5, 1))),
    "filter_year_yoy": on_star(sales.revenue_yoy, Filters(years=(1995, 1997))),
    "filter_brand_share": on_star(
        performance.revenue_by_brand, Filters(brands=("Brand#11", "Brand#23"))
    ),
    "filter_category_share": on_star(
        performance.category_revenue_share, Filters(categories=("STANDARD", "PROMO"))
    ),
    "filter_brand_inventory": on_star(
        inventory.inventory_value_by_brand, Filters(brands=("Brand#11",))
    ),
}

STORED: dict[str, Query] = {
    "filter_store_pushed": on_star(
        on_stored_facts(sales.sales_kpis, Filters(stores=("ASIA Store", "EUROPE Store")))
    ),
    "filter_brand_pushed": on_star(
        on_stored_facts(sales.sales_kpis, Filters(brands=("Brand#11", "Brand#23")))
    ),
}

STREAM: dict[str, Query] = {"snapshot_stream": on_sources(streamed_history)}

DASHBOARD = {**SALES, **INVENTORY, **PERFORMANCE, **FILTERS}

QUERIES: dict[str, Query] = {**INGEST, **KEYS, **MODELS, **QUALITY, **DASHBOARD, **STORED, **STREAM}
