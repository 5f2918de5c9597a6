"""Whole-table reads from the transactional database, split over executors."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.sources.schemas import SourceTable

CONNECT_TIMEOUT_SECONDS = 30
FETCH_SIZE = 10_000
MOST_VALUES = {"stocks": "product_id"}
CONNECTIONS = 32  # reads of one table under way at the same time
SYSTEM_SCHEMAS = ("pg_catalog", "information_schema")


@dataclass(frozen=True)
class Connection:
    host: str
    database: str
    user: str
    password: str
    port: int = 5432
    sslmode: str = "require"

    @classmethod
    def from_environment(cls, env: Mapping[str, str] = os.environ) -> Connection:
        return cls(
            host=env["DATASOURCE_HOST"],
            port=int(env.get("DATASOURCE_PORT", "5432")),
            database=env["DATASOURCE_DATABASE"],
            user=env["DATASOURCE_USER"],
            password=env["DATASOURCE_PASSWORD"],
            sslmode=env.get("DATASOURCE_SSLMODE", "require"),
        )

    @property
    def url(self) -> str:
        return (
            f"jdbc:postgresql://{self.host}:{self.port}/{self.database}"
            f"?sslmode={self.sslmode}&connectTimeout={CONNECT_TIMEOUT_SECONDS}"
        )

    def options(self) -> dict[str, str]:
        return {
            "url": self.url,
            "user": self.user,
            "password": self.password,
            "driver": "org.postgresql.Driver",
            "fetchsize": str(FETCH_SIZE),
        }


def read_query(spark: SparkSession, connection: Connection, query: str) -> DataFrame:
    return (
        spark.read.format("jdbc").options(**connection.options()).option("query", query).load()
    )


def split_options(
    key: str, low: int, high: int, rows: int, rows_per_task: int, connections: int = CONNECTIONS
) -> dict[str, str]:
    """Range split of a numeric key into reads of about `rows_per_task` rows, in as many parts as
    the database takes connections at most: each part is a connection."""
    return {
        "partitionColumn": key,
        "lowerBound": str(low),
        "upperBound": str(high + 1),
        "numPartitions": str(max(1, min(connections, -(-rows // rows_per_task)))),
    }


def split_column(table: SourceTable) -> str:
    """The key column to split by, the one with the most values: products of stocks, whose rows of
    one store may be a third of the table; the first key column of all others."""
    return MOST_VALUES.get(table.name, table.key[0])


def full_load(
    spark: SparkSession,
    connection: Connection,
    table: SourceTable,
    rows_per_task: int = 1_000_000,
    connections: int = CONNECTIONS,
) -> DataFrame:
    """The whole table as the database has it; landing holds its columns against the declared ones.
    Executors each read a range of a key column.

    The ranges are read by connections of their own at moments of their own: a load is one
    consistent snapshot only if the table does not change meanwhile, or on a replica that is held.
    """
    quoted = f'"{table.schema}"."{table.name}"'
    key = split_column(table)
    extent = read_query(
        spark,
        connection,
        f'select min("{key}") as low, max("{key}") as high, count(*) as total from {quoted}',
    ).first()
    reader = spark.read.format("jdbc").options(**connection.options()).option("dbtable", quoted)
    if extent["total"]:
        split = split_options(
            key, extent["low"], extent["high"], extent["total"], rows_per_task, connections
        )
        reader = reader.options(**split)
    return reader.load()


def list_tables(
    spark: SparkSession, connection: Connection, schema: str | None = None
) -> DataFrame:
    """Base tables of one schema, or of all but the system schemas."""
    catalog = (
        spark.read.format("jdbc")
        .options(**connection.options())
        .option("dbtable", "information_schema.tables")
        .load()
    )
    return base_tables(catalog, schema)


def base_tables(catalog: DataFrame, schema: str | None = None) -> DataFrame:
    """The catalog filter on its own: it works on any frame shaped like information_schema."""
    wanted = (
        F.col("table_schema") == schema
        if schema
        else ~F.col("table_schema").isin(*SYSTEM_SCHEMAS)
    )
    return (
        catalog.where((F.col("table_type") == "BASE TABLE") & wanted)
        .select("table_schema", "table_name")
        .orderBy("table_schema", "table_name")
    )
