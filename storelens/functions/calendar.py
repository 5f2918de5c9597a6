"""Calendar attributes of a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_attributes(day: str) -> list[str]:
    """As SQL expressions; Sunday is day 0."""
    return [
        f"year({day}) as year_number",
        f"quarter({day}) as quarter_number",
        f"'Q' || quarter({day}) as quarter_label",
        f"month({day}) as month_number",
        f"date_format({day}, 'MMMM') as month_name",
        f"weekofyear({day}) as week_of_year",
        f"day({day}) as day_of_month",
        f"dayofweek({day}) - 1 as day_of_week",
        f"date_format({day}, 'EEEE') as day_name",
        f"dayofweek({day}) in (1, 7) as is_weekend",
    ]


def month_year_label(day: Column) -> Column:
    return F.date_format(day, "MMM yyyy")


def quarter_year_label(year: Column, quarter: Column) -> Column:
    return F.concat(F.lit("Q"), quarter.cast("string"), F.lit(" "), year.cast("string"))
