"""Selecting the newest snapshot of a landed table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.sources.schemas import SOURCE_NAME, SourceTable


def latest_full_load(df: DataFrame, by: str = "ingestion_date") -> DataFrame:
    """Rows of the newest `by` value.

    The maximum is a scalar subquery, so on a partitioned table it becomes a partition filter
    and only the newest partition is read; a join would scan every snapshot.
    """
    newest = df.agg(F.max(by)).scalar()
    return df.where(F.col(by) == newest)


def latest_run(df: DataFrame, manifest: DataFrame, table: SourceTable) -> DataFrame:
    """As `latest_full_load`, and of several loads on that day only the one that ran last.

    Both values come from the manifest, which is small, rather than from listing the table.
    """
    runs = manifest.where(
        (F.col("source") == SOURCE_NAME)
        & (F.col("schema") == table.schema)
        & (F.col("table") == table.name)
    ).select(F.struct("ingestion_date", "loaded_at", "run_id").alias("run"))
    newest = runs.agg(F.max("run")).scalar()
    return df.where(
        (F.col("ingestion_date") == newest.getField("ingestion_date"))
        & (F.col("run_id") == newest.getField("run_id"))
    )


def runs_per_date(manifest: DataFrame, table: SourceTable) -> DataFrame:
    """The load that ran last on each date: ingestion_date, run_id."""
    return (
        manifest.where(
            (F.col("source") == SOURCE_NAME)
            & (F.col("schema") == table.schema)
            & (F.col("table") == table.name)
        )
        .groupBy("ingestion_date")
        .agg(F.max_by("run_id", F.struct("loaded_at", "run_id")).alias("run_id"))
    )


def last_run_per_date(df: DataFrame, manifest: DataFrame, table: SourceTable) -> DataFrame:
    """Every snapshot date, each with only the load that ran last on it."""
    return df.join(runs_per_date(manifest, table), ["ingestion_date", "run_id"], "left_semi")
