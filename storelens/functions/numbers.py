"""Money and ratios. Money stays DECIMAL; ratios are DOUBLE, cast before dividing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
MONEY_SUM = "decimal(28,2)"


def line_total() -> Column:
    return F.expr(f"cast(round(quantity * list_price * (1 - discount), 2) as {MONEY})")


def inventory_value() -> Column:
    return F.expr(f"cast(round(quantity * list_price, 2) as {MONEY})")


def money_sum(column: str) -> Column:
    """Exact sum of a MONEY column. DECIMAL adds ten digits to a sum, enough for 1e10 of the
    largest values."""
    return F.sum(column).cast(MONEY_SUM)


def ratio(numerator: Column, denominator: Column) -> Column:
    """NULL when the denominator is 0 or NULL (ANSI mode raises on a plain division by 0)."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def divide0(numerator: Column, denominator: Column) -> Column:
    """0 when the denominator, or the whole ratio, is 0 or NULL."""
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def percent(part: Column, total: Column) -> Column:
    return ratio(part.cast("double") * 100.0, total)


def mean(total: Column, count: Column) -> Column:
    """Average of a DECIMAL as a DOUBLE: exact sum first, one division last."""
    return ratio(total, count)
