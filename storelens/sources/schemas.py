"""The nine source tables with their fixed column types."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

SOURCE_NAME = "supabase"  # fixed value: folder name in the raw layer
PARTITIONS = ("ingestion_date", "run_id")


@dataclass(frozen=True)
class SourceTable:
    schema: str
    name: str
    columns: tuple[tuple[str, str], ...]
    key: tuple[str, ...]

    @property
    def relative_path(self) -> str:
        return f"{SOURCE_NAME}/{self.schema}/{self.name}"

    @property
    def ddl(self) -> str:
        return ", ".join(f"{name} {kind}" for name, kind in self.columns)

    @property
    def landed_ddl(self) -> str:
        return f"{self.ddl}, ingestion_date date, run_id string"

    def conform(self, df: DataFrame, *extra: str) -> DataFrame:
        """Exactly the declared columns and types, then `extra` columns as they are.

        An integer key that an untyped writer stored as a double (because it held a NULL) comes
        back as an integer here, so that its hash agrees with the dimension's.
        """
        declared = [f"cast({name} as {kind}) as {name}" for name, kind in self.columns]
        return df.selectExpr(*declared, *extra)


# The tables with their columns, types and keys.
SALES_TABLES = [
    SourceTable(
        schema="sales",
        name="customers",
        columns=(
            ("customer_id", "bigint"),
            ("first_name", "string"),
            ("last_name", "string"),
            ("email", "string"),
            ("phone", "string"),
            ("street", "string"),
            ("city", "string"),
            ("state", "string"),
            ("zip_code", "string"),
        ),
        key=("customer_id",),
    ),
    SourceTable(
        schema="sales",
        name="order_items",
        columns=(
            ("order_id", "bigint"),
            ("item_id", "int"),
            ("product_id", "bigint"),
            ("quantity", "int"),
            ("list_price", "decimal(10,2)"),
            ("discount", "decimal(4,2)"),
        ),
        key=("order_id", "item_id"),
    ),
    SourceTable(
        schema="sales",
        name="orders",
        columns=(
            ("order_id", "bigint"),
            ("customer_id", "bigint"),
            ("order_status", "smallint"),
            ("order_date", "date"),
            ("required_date", "date"),
            ("shipped_date", "date"),
            ("store_id", "int"),
            ("staff_id", "bigint"),
        ),
        key=("order_id",),
    ),
    SourceTable(
        schema="sales",
        name="staffs",
        columns=(
            ("staff_id", "bigint"),
            ("first_name", "string"),
            ("last_name", "string"),
            ("email", "string"),
            ("phone", "string"),
            ("active", "smallint"),
            ("store_id", "int"),
            ("manager_id", "bigint"),
        ),
        key=("staff_id",),
    ),
    SourceTable(
        schema="sales",
        name="stores",
        columns=(
            ("store_id", "int"),
            ("store_name", "string"),
            ("phone", "string"),
            ("email", "string"),
            ("street", "string"),
            ("city", "string"),
            ("state", "string"),
            ("zip_code", "string"),
        ),
        key=("store_id",),
    ),
]

PRODUCTION_TABLES = [
    SourceTable(
        schema="production",
        name="brands",
        columns=(
            ("brand_id", "int"),
            ("brand_name", "string"),
        ),
        key=("brand_id",),
    ),
    SourceTable(
        schema="production",
        name="categories",
        columns=(
            ("category_id", "int"),
            ("category_name", "string"),
        ),
        key=("category_id",),
    ),
    SourceTable(
        schema="production",
        name="products",
        columns=(
            ("product_id", "bigint"),
            ("product_name", "string"),
            ("brand_id", "int"),
            ("category_id", "int"),
            ("model_year", "smallint"),
            ("list_price", "decimal(10,2)"),
        ),
        key=("product_id",),
    ),
    SourceTable(
        schema="production",
        name="stocks",
        columns=(
            ("store_id", "int"),
            ("product_id", "bigint"),
            ("quantity", "int"),
        ),
        key=("store_id", "product_id"),
    ),
]

TABLES = {table.name: table for table in SALES_TABLES + PRODUCTION_TABLES}
