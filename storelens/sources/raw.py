"""The raw layer: whole-table snapshots below ingestion_date=…/run_id=…"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from storelens.session import folder_exists
from storelens.sources.drift import compare
from storelens.sources.schemas import PARTITIONS, SOURCE_NAME, SourceTable

STRATEGY = "full_load"
MANIFEST = "_manifest"
MANIFEST_DDL = (
    "ingestion_strategy string, row_count bigint, path string, duration_seconds double, "
    "loaded_at timestamp, source string, schema string, table string, ingestion_date date, "
    "run_id string, schema_changes string"
)


@dataclass(frozen=True)
class Load:
    """One run of the ingest job."""

    ingestion_date: dt.date
    run_id: str

    @classmethod
    def today(cls) -> Load:
        return cls(dt.datetime.now(dt.timezone.utc).date(), uuid.uuid4().hex)


def table_path(root: str, table: SourceTable) -> str:
    return f"{root}/raw/{table.relative_path}"


def snapshot_path(root: str, table: SourceTable, load: Load) -> str:
    return (
        f"{table_path(root, table)}/ingestion_date={load.ingestion_date.isoformat()}"
        f"/run_id={load.run_id}"
    )


def manifest_path(root: str, table: SourceTable, load: Load) -> str:
    """Each load's row has a folder of its own: loads running at the same time do not meet, and
    a rerun replaces its row."""
    return (
        f"{root}/raw/{MANIFEST}/source={SOURCE_NAME}/schema={table.schema}/table={table.name}"
        f"/ingestion_date={load.ingestion_date.isoformat()}/run_id={load.run_id}"
    )


def write_snapshot(df: DataFrame, root: str, table: SourceTable, load: Load) -> None:
    """Land one snapshot, then note it in the manifest.

    The row count is observed on the write itself, so the source is read once. Rerunning a load
    replaces its own folder and leaves all others alone. A column that is not declared is kept, and
    the manifest tells of it, as of types that are narrower than declared; a declared column that
    is gone or whose values may not fit stops the load before anything is written.
    """
    drift = compare(table, df.schema)
    drift.require_sound(table)
    # a column of nulls only has no type of its own
    added = [f"`{name}`" if kind != "void" else f"cast(`{name}` as string) as `{name}`" for name, kind in drift.added.items()]
    started = time.time()
    observed = Observation()
    path = snapshot_path(root, table, load)
    (
        table.conform(df, *added)
        .observe(observed, F.count(F.lit(1)).alias("row_count"))
        .write.mode("overwrite")
        .parquet(path)
    )
    row = df.sparkSession.range(0, 1, 1, 1).select(
        F.lit(STRATEGY).alias("ingestion_strategy"),
        F.lit(observed.get["row_count"]).cast("bigint").alias("row_count"),
        F.lit(path).alias("path"),
        F.lit(round(time.time() - started, 2)).alias("duration_seconds"),
        F.lit(dt.datetime.now(dt.timezone.utc)).alias("loaded_at"),
        F.lit(drift.note()).cast("string").alias("schema_changes"),
    )
    row.write.mode("overwrite").parquet(manifest_path(root, table, load))


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(MANIFEST_DDL).parquet(f"{root}/raw/{MANIFEST}")


def scan(spark: SparkSession, root: str, table: SourceTable, undeclared: str = "") -> DataFrame:
    """All landed snapshots of a table with their partition columns.

    The declared schema is used for reading, so a file whose types have drifted fails the read
    instead of changing the result. `undeclared` names further columns with their types ("note
    string, size int"); loads that did not have them show null.
    """
    columns = f"{undeclared}, {table.landed_ddl}" if undeclared else table.landed_ddl
    return spark.read.schema(columns).parquet(table_path(root, table))


def scan_untyped(spark: SparkSession, root: str, table: SourceTable) -> DataFrame:
    """As `scan`, for snapshots written without fixed types: read as found, then cast."""
    return table.conform(spark.read.parquet(table_path(root, table)), *PARTITIONS)


def reconcile(spark: SparkSession, root: str, tables: Iterable[SourceTable]) -> DataFrame:
    """The rows that the manifest records of each load next to those that can be read back.

    status: same; differs; missing (recorded, no rows found although some should be there); not
    recorded (a folder without a manifest row, as an unfinished load leaves). Counting reads the
    files' footers only. Tables that never landed have no row.
    """
    load = ["source", "schema", "table", "ingestion_date", "run_id"]
    recorded = read_manifest(spark, root).select(*load, F.col("row_count").alias("recorded"))
    found = [
        scan(spark, root, table)
        .groupBy("ingestion_date", "run_id")
        .agg(F.count(F.lit(1)).alias("found"))
        .select(
            F.lit(SOURCE_NAME).alias("source"), F.lit(table.schema).alias("schema"),
            F.lit(table.name).alias("table"), "ingestion_date", "run_id", "found",
        )
        for table in tables
        if folder_exists(spark, table_path(root, table))
    ]
    if not found:
        found = [recorded.limit(0).withColumnRenamed("recorded", "found")]
    both = recorded.join(reduce(DataFrame.unionByName, found), load, "full")
    status = (
        F.when(F.col("recorded").isNull(), "not recorded")
        .when(F.coalesce("found", F.lit(0)) == F.col("recorded"), "same")
        .when(F.col("found").isNull(), "missing")
        .otherwise("differs")
    )
    return both.select(*load, "recorded", F.coalesce("found", F.lit(0)).alias("found"), status.alias("status"))
