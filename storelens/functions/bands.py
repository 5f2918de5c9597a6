"""Labels and bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Codes, limits and labels as the dashboards define them.
ORDER_STATUS = {1: "Pending", 2: "Processing", 3: "Rejected", 4: "Completed"}
REVENUE_BANDS = [
    (3000, "Premium   (≥ $3K)"),
    (1000, "Mid-Range ($1K–$3K)"),
    (300, "Entry     ($300–$1K)"),
]
LOWEST_REVENUE_BAND = "Budget    (< $300)"
CRITICAL_STOCK = 2
LOW_STOCK = 5


def order_status_label(status: str) -> Column:
    """An unknown code has no label."""
    branches = " ".join(f"when {code} then '{label}'" for code, label in ORDER_STATUS.items())
    return F.expr(f"case {status} {branches} end")


def revenue_band(amount: str) -> Column:
    branches = " ".join(f"when {amount} >= {floor} then '{label}'" for floor, label in REVENUE_BANDS)
    return F.expr(f"case {branches} else '{LOWEST_REVENUE_BAND}' end")


def alert_level(quantity: Column) -> Column:
    return (
        F.when(quantity <= CRITICAL_STOCK, "Critical")
        .when(quantity <= LOW_STOCK, "Warning")
        .otherwise("OK")
    )


def is_low_stock(quantity: Column, threshold: int = LOW_STOCK) -> Column:
    return quantity <= threshold


def model_year_group(year: Column) -> Column:
    return (
        F.when(year >= 2018, "2018 (Current)")
        .when(year == 2017, "2017")
        .when(year == 2016, "2016")
        .when(year <= 2015, "2015 & Earlier")
        .otherwise("Unknown")
    )


def staff_level(manager_id: Column) -> Column:
    return F.when(manager_id.isNull(), "Manager").otherwise("Staff")
