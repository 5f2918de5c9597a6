"""The checks of the warehouse, as data.

Fixed values: which columns are unique, required, limited to a list or refer to a dimension.
"""

from __future__ import annotations

from storelens.operators.quality import (
    ACCEPTED_VALUES,
    NOT_NULL,
    RELATIONSHIPS,
    UNIQUE,
    Check,
)

UNIQUE_COLUMNS = {
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

REQUIRED_COLUMNS = {
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

ORDER_STATUS_MODELS = ("stg_orders", "fct_sales")
ORDER_STATUS_VALUES = (1, 2, 3, 4)

PARENTS = {
    "fct_sales": ("dim_date", "dim_customer", "dim_product", "dim_store", "dim_staff"),
    "fct_inventory": ("dim_date", "dim_store", "dim_product"),
}


def _per_column(columns: dict[str, tuple[str, ...]], test: str) -> list[Check]:
    return [Check(model, column, test) for model, names in columns.items() for column in names]


SUITE: list[Check] = [
    *_per_column(UNIQUE_COLUMNS, UNIQUE),
    *_per_column(REQUIRED_COLUMNS, NOT_NULL),
    *[
        Check(model, "order_status", ACCEPTED_VALUES, values=ORDER_STATUS_VALUES)
        for model in ORDER_STATUS_MODELS
    ],
    *[
        Check(fact, f"{dim}_sk", RELATIONSHIPS, parent=dim)
        for fact, dims in PARENTS.items()
        for dim in dims
    ],
]

# The composite grain, through the hash keys; the history's key holds the date too.
COMPOSITE_UNIQUE: list[Check] = [
    Check("fct_sales", "sales_pk", UNIQUE),
    Check("fct_inventory", "inventory_pk", UNIQUE),
    Check("fct_inventory_history", "inventory_pk", UNIQUE),
]


def only(test: str) -> list[Check]:
    return [check for check in SUITE if check.test == test]
