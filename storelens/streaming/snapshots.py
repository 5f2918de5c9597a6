"""Inventory history kept up to date as stock snapshots land, by builds and by a stream alike.

Each snapshot date is a part of the stored history with a record of its own: the load and the
checksum of the products that it was made from. Whoever writes, a date is written if its record
does not say what is to be written, and the record comes after the rows. So a build after a stream
finds nothing to do, and a writer that dies in between leaves a date to be written again.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.functions.numbers import money_sum
from storelens.operators.facts import fct_inventory_history
from storelens.operators.loads import last_run_per_date, runs_per_date
from storelens.operators.staging import stg_stocks
from storelens.plans.layout import PARTITION_BY, laid_out, stored_order
from storelens.plans.model_schemas import ddl
from storelens.sources import raw, versions
from storelens.sources.schemas import TABLES
from storelens.sources.versions import Part, State

STOCKS = TABLES["stocks"]
HISTORY = "fct_inventory_history"
BY_DATE = PARTITION_BY[HISTORY]
DAILY_DDL = (
    "dim_date_sk string, dim_store_sk string, brand_id int, category_id int, units bigint, "
    "value decimal(28,2), snapshot_date date"
)


def daily_path(target: str) -> str:
    """Where the sums of a history are; they go by the history's versions and records."""
    return f"{target}_daily"


def daily_sums(history: DataFrame, products: DataFrame) -> DataFrame:
    """Units and value per snapshot date, store, brand and category.

    Summed per product first, so the join sees one row per date, store and product at most.
    """
    by_product = history.groupBy(BY_DATE, "dim_date_sk", "dim_store_sk", "product_id").agg(
        F.sum("quantity").alias("units"), money_sum("inventory_value").alias("value")
    )
    attributes = products.select("product_id", "brand_id", "category_id")
    return (
        by_product.join(attributes, "product_id", "left")
        .groupBy("dim_date_sk", "dim_store_sk", "brand_id", "category_id", BY_DATE)
        .agg(F.sum("units").alias("units"), F.sum("value").cast("decimal(28,2)").alias("value"))
    )


def _checksum(products: DataFrame) -> int:
    """Of what the history and its sums take from the products."""
    row = F.xxhash64("product_id", "list_price", "brand_id", "category_id")
    return products.agg(F.bit_xor(row)).first()[0] or 0


def wanted_parts(spark: SparkSession, root: str, products: DataFrame) -> dict[str, str]:
    """Per landed snapshot date what its part is to be made from: a row per date."""
    checksum = _checksum(products)
    runs = runs_per_date(raw.read_manifest(spark, root), STOCKS).collect()
    return {r.ingestion_date.isoformat(): json.dumps([r.run_id, checksum]) for r in runs}


def update_history(
    spark: SparkSession, root: str, products: DataFrame, target: str, dates: list[dt.date] | None = None
) -> list[str]:
    """Write the snapshot dates, all or some, whose records do not say what is landed, and return
    them. Their rows go to a new folder; then the records change, of all of them at once."""
    wanted = wanted_parts(spark, root, products)
    if dates is not None:
        wanted = {d: w for d, w in wanted.items() if dt.date.fromisoformat(d) in set(dates)}
    _, state = versions.read_state(spark, target)
    stale = sorted(d for d, made_from in wanted.items() if d not in state or state[d].made_from != made_from)
    if not stale:
        return []
    version = versions.new_version()
    folder = versions.version_path(target, version)
    days = [dt.date.fromisoformat(d) for d in stale]
    landed = raw.scan(spark, root, STOCKS).where(F.col("ingestion_date").isin(*days))
    stocks = last_run_per_date(landed, raw.read_manifest(spark, root), STOCKS)
    history = fct_inventory_history(
        stg_stocks(stocks), products, by_snapshot=True, in_order=stored_order(HISTORY)
    )
    laid_out(history, HISTORY, in_order=True).parquet(folder)
    stored = spark.read.schema(ddl(HISTORY)).parquet(folder)
    sums = daily_sums(stored, products).hint("rebalance", BY_DATE)
    sums.write.partitionBy(BY_DATE).parquet(versions.version_path(daily_path(target), version))
    # a row per date; a date whose last load is empty has a record and no folder
    filled = {r[0].isoformat() for r in stored.select(BY_DATE).distinct().collect()}
    own = {d: Part(version if d in filled else None, wanted[d]) for d in stale}

    def change(state: State) -> State:
        # another writer may have done some of them meanwhile, from the same load or a later one
        latest = wanted_parts(spark, root, products)
        by_date = {d: part for d, part in state.items() if d != versions.WHOLE}
        done = {d for d in own if d in by_date and by_date[d].made_from == latest.get(d)}
        return {**by_date, **{d: part for d, part in own.items() if d not in done}}

    versions.commit(spark, target, change)
    versions.drop_old_versions(spark, target, also=(daily_path(target),))
    return stale


def read_history(spark: SparkSession, target: str) -> DataFrame:
    _, state = versions.read_state(spark, target)
    return versions.current_parts(spark, target, state, ddl(HISTORY), BY_DATE)


def read_daily_sums(spark: SparkSession, target: str) -> DataFrame:
    _, state = versions.read_state(spark, target)
    return versions.current_parts(spark, daily_path(target), state, DAILY_DDL, BY_DATE)


def snapshot_stream(
    spark: SparkSession, root: str, products: DataFrame, target: str, checkpoint: str
):
    """Start a run that takes in all loads since the last one and then stops.

    The stream follows the manifest, whose rows appear once a snapshot is complete: it is small
    and names the dates, so stock files are read once, for the dates that changed. A batch says
    which dates are affected, not which rows: two loads of one day, in one batch or two, still
    leave the later one only.
    """

    def refresh(batch: DataFrame, _epoch: int) -> None:
        rows = batch.select("ingestion_date").distinct().collect()  # one row per new date
        if rows:
            update_history(batch.sparkSession, root, products, target, [r.ingestion_date for r in rows])

    loads = (
        spark.readStream.schema(raw.MANIFEST_DDL)
        .parquet(f"{root}/raw/{raw.MANIFEST}")
        .where((F.col("schema") == STOCKS.schema) & (F.col("table") == STOCKS.name))
    )
    return (
        loads.writeStream.foreachBatch(refresh)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
