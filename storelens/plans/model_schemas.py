"""Column types of the stored models."""

from __future__ import annotations

# The models with their columns and types, as they are stored.
COLUMNS: dict[str, tuple[tuple[str, str], ...]] = {
    "stg_customers": (
        ("customer_id", "bigint"),
        ("first_name", "string"),
        ("last_name", "string"),
        ("full_name", "string"),
        ("email", "string"),
        ("phone", "string"),
        ("street", "string"),
        ("city", "string"),
        ("state", "string"),
        ("zip_code", "string"),
    ),
    "stg_orders": (
        ("order_id", "bigint"),
        ("customer_id", "bigint"),
        ("order_status", "smallint"),
        ("order_status_label", "string"),
        ("order_date", "date"),
        ("required_date", "date"),
        ("shipped_date", "date"),
        ("is_shipped", "boolean"),
        ("store_id", "int"),
        ("staff_id", "bigint"),
    ),
    "stg_order_items": (
        ("order_id", "bigint"),
        ("item_id", "int"),
        ("product_id", "bigint"),
        ("quantity", "int"),
        ("list_price", "decimal(10,2)"),
        ("discount", "decimal(4,2)"),
        ("line_total", "decimal(18,2)"),
    ),
    "stg_staffs": (
        ("staff_id", "bigint"),
        ("first_name", "string"),
        ("last_name", "string"),
        ("full_name", "string"),
        ("email", "string"),
        ("phone", "string"),
        ("is_active", "boolean"),
        ("store_id", "int"),
        ("manager_id", "bigint"),
    ),
    "stg_stores": (
        ("store_id", "int"),
        ("store_name", "string"),
        ("phone", "string"),
        ("email", "string"),
        ("street", "string"),
        ("city", "string"),
        ("state", "string"),
        ("zip_code", "string"),
    ),
    "stg_brands": (
        ("brand_id", "int"),
        ("brand_name", "string"),
    ),
    "stg_categories": (
        ("category_id", "int"),
        ("category_name", "string"),
    ),
    "stg_products": (
        ("product_id", "bigint"),
        ("product_name", "string"),
        ("brand_id", "int"),
        ("category_id", "int"),
        ("model_year", "smallint"),
        ("list_price", "decimal(10,2)"),
    ),
    "stg_stocks": (
        ("store_id", "int"),
        ("product_id", "bigint"),
        ("quantity", "int"),
        ("snapshot_date", "date"),
    ),
    "dim_customer": (
        ("dim_customer_sk", "string"),
        ("customer_id", "bigint"),
        ("first_name", "string"),
        ("last_name", "string"),
        ("full_name", "string"),
        ("email", "string"),
        ("phone", "string"),
        ("street", "string"),
        ("city", "string"),
        ("state", "string"),
        ("zip_code", "string"),
    ),
    "dim_product": (
        ("dim_product_sk", "string"),
        ("product_id", "bigint"),
        ("product_name", "string"),
        ("model_year", "smallint"),
        ("list_price", "decimal(10,2)"),
        ("brand_id", "int"),
        ("brand_name", "string"),
        ("category_id", "int"),
        ("category_name", "string"),
    ),
    "dim_store": (
        ("dim_store_sk", "string"),
        ("store_id", "int"),
        ("store_name", "string"),
        ("phone", "string"),
        ("email", "string"),
        ("street", "string"),
        ("city", "string"),
        ("state", "string"),
        ("zip_code", "string"),
    ),
    "dim_staff": (
        ("dim_staff_sk", "string"),
        ("staff_id", "bigint"),
        ("first_name", "string"),
        ("last_name", "string"),
        ("full_name", "string"),
        ("email", "string"),
        ("phone", "string"),
        ("is_active", "boolean"),
        ("store_id", "int"),
        ("manager_id", "bigint"),
        ("manager_dim_staff_sk", "string"),
        ("manager_full_name", "string"),
    ),
    "dim_date": (
        ("dim_date_sk", "string"),
        ("date_day", "date"),
        ("year_number", "int"),
        ("quarter_number", "int"),
        ("quarter_label", "string"),
        ("month_number", "int"),
        ("month_name", "string"),
        ("week_of_year", "int"),
        ("day_of_month", "int"),
        ("day_of_week", "int"),
        ("day_name", "string"),
        ("is_weekend", "boolean"),
    ),
    "fct_sales": (
        ("sales_pk", "string"),
        ("dim_date_sk", "string"),
        ("dim_customer_sk", "string"),
        ("dim_product_sk", "string"),
        ("dim_store_sk", "string"),
        ("dim_staff_sk", "string"),
        ("order_id", "bigint"),
        ("item_id", "int"),
        ("order_status", "smallint"),
        ("order_status_label", "string"),
        ("is_shipped", "boolean"),
        ("order_date", "date"),
        ("required_date", "date"),
        ("shipped_date", "date"),
        ("quantity", "int"),
        ("list_price", "decimal(10,2)"),
        ("discount", "decimal(4,2)"),
        ("line_total", "decimal(18,2)"),
        ("order_month", "date"),
    ),
    "fct_inventory": (
        ("inventory_pk", "string"),
        ("dim_date_sk", "string"),
        ("dim_store_sk", "string"),
        ("dim_product_sk", "string"),
        ("store_id", "int"),
        ("product_id", "bigint"),
        ("snapshot_date", "date"),
        ("quantity", "int"),
        ("inventory_value", "decimal(18,2)"),
    ),
    "fct_inventory_history": (
        ("inventory_pk", "string"),
        ("dim_date_sk", "string"),
        ("dim_store_sk", "string"),
        ("dim_product_sk", "string"),
        ("store_id", "int"),
        ("product_id", "bigint"),
        ("snapshot_date", "date"),
        ("quantity", "int"),
        ("inventory_value", "decimal(18,2)"),
    ),
}


def ddl(model: str) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in COLUMNS[model])
