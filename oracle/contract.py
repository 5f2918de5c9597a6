"""What the results are held against: bands, checks and source tables, stated on their own."""

from __future__ import annotations

# Least revenue of a line in each band, and the band below them.
REVENUE_BANDS = (
    (3000, "Premium   (≥ $3K)"),
    (1000, "Mid-Range ($1K–$3K)"),
    (300, "Entry     ($300–$1K)"),
)
LOWEST_REVENUE_BAND = "Budget    (< $300)"

# Columns that must be unique, must be filled, or refer to a dimension.
UNIQUE = {
    "stg_customers": ("customer_id",),
    "stg_orders": ("order_id",),
    "stg_staffs": ("staff_id", "email"),
    "stg_stores": ("store_id",),
    "stg_brands": ("brand_id",),
    "stg_categories": ("category_id",),
    "stg_products": ("product_id",),
    "dim_customer": ("dim_customer_sk", "customer_id"),
    "dim_product": ("dim_product_sk", "product_id"),
    "dim_store": ("dim_store_sk", "store_id"),
    "dim_staff": ("dim_staff_sk", "staff_id"),
    "dim_date": ("dim_date_sk",),
    "fct_sales": ("sales_pk",),
    "fct_inventory": ("inventory_pk",),
}

FILLED = {
    "stg_customers": ("customer_id", "first_name", "last_name", "full_name", "email"),
    "stg_orders": (
        "order_id", "order_status", "order_status_label", "order_date", "is_shipped",
        "store_id", "staff_id",
    ),
    "stg_order_items": ("order_id", "item_id", "product_id", "quantity", "list_price", "discount", "line_total"),
    "stg_staffs": ("staff_id", "first_name", "last_name", "full_name", "email", "is_active", "store_id"),
    "stg_stores": ("store_id", "store_name"),
    "stg_brands": ("brand_id", "brand_name"),
    "stg_categories": ("category_id", "category_name"),
    "stg_products": ("product_id", "product_name", "brand_id", "category_id", "model_year", "list_price"),
    "stg_stocks": ("store_id", "product_id", "quantity", "snapshot_date"),
    "dim_customer": ("dim_customer_sk", "customer_id", "first_name", "last_name", "full_name"),
    "dim_product": (
        "dim_product_sk", "product_id", "product_name", "brand_id", "brand_name",
        "category_id", "category_name",
    ),
    "dim_store": ("dim_store_sk", "store_id", "store_name"),
    "dim_staff": (
        "dim_staff_sk", "staff_id", "first_name", "last_name", "full_name", "is_active",
        "store_id", "manager_dim_staff_sk",
    ),
    "dim_date": ("dim_date_sk",),
    "fct_sales": (
        "sales_pk", "dim_date_sk", "dim_customer_sk", "dim_product_sk", "dim_store_sk",
        "dim_staff_sk", "order_id", "item_id", "order_status", "order_status_label",
        "is_shipped", "order_date", "quantity", "list_price", "discount", "line_total",
    ),
    "fct_inventory": (
        "inventory_pk", "dim_date_sk", "dim_store_sk", "dim_product_sk", "store_id",
        "product_id", "snapshot_date", "quantity", "inventory_value",
    ),
}

PARENTS = {
    "fct_sales": ("dim_date", "dim_customer", "dim_product", "dim_store", "dim_staff"),
    "fct_inventory": ("dim_date", "dim_store", "dim_product"),
}

STATUS_MODELS = ("stg_orders", "fct_sales")
STATUS_VALUES = (1, 2, 3, 4)
COMPOSITE_UNIQUE = {
    "fct_sales": ("sales_pk",),
    "fct_inventory": ("inventory_pk",),
    "fct_inventory_history": ("inventory_pk",),
}

# Source tables by schema, with columns and types.
SOURCES = {
    "sales": {
        "customers": (
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
        "order_items": (
            ("order_id", "bigint"),
            ("item_id", "int"),
            ("product_id", "bigint"),
            ("quantity", "int"),
            ("list_price", "decimal(10,2)"),
            ("discount", "decimal(4,2)"),
        ),
        "orders": (
            ("order_id", "bigint"),
            ("customer_id", "bigint"),
            ("order_status", "smallint"),
            ("order_date", "date"),
            ("required_date", "date"),
            ("shipped_date", "date"),
            ("store_id", "int"),
            ("staff_id", "bigint"),
        ),
        "staffs": (
            ("staff_id", "bigint"),
            ("first_name", "string"),
            ("last_name", "string"),
            ("email", "string"),
            ("phone", "string"),
            ("active", "smallint"),
            ("store_id", "int"),
            ("manager_id", "bigint"),
        ),
        "stores": (
            ("store_id", "int"),
            ("store_name", "string"),
            ("phone", "string"),
            ("email", "string"),
            ("street", "string"),
            ("city", "string"),
            ("state", "string"),
            ("zip_code", "string"),
        ),
    },
    "production": {
        "brands": (
            ("brand_id", "int"),
            ("brand_name", "string"),
        ),
        "categories": (
            ("category_id", "int"),
            ("category_name", "string"),
        ),
        "products": (
            ("product_id", "bigint"),
            ("product_name", "string"),
            ("brand_id", "int"),
            ("category_id", "int"),
            ("model_year", "smallint"),
            ("list_price", "decimal(10,2)"),
        ),
        "stocks": (
            ("store_id", "int"),
            ("product_id", "bigint"),
            ("quantity", "int"),
        ),
    },
}
