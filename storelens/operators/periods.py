"""Comparison with an earlier period.

All inputs are aggregated to days, years or snapshots first, so their number of rows is bounded
by the calendar, whatever the size of the fact.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def shown_on(daily: DataFrame, day: str, years_back: Iterable[int]) -> DataFrame:
    """Each day's row once under its own date and once per offset under the date `years_back`
    years later, where it is the earlier value. 29 February is shown on 28 February.

    Current and earlier values then come out of one grouping: the fact is read once, and no
    self-join is needed.
    """
    copies = [
        F.struct(
            F.lit(n).alias("years_back"), F.add_months(F.col(day), 12 * n).alias("shown_date")
        )
        for n in (0, *years_back)
    ]
    return daily.select("*", F.inline(F.array(*copies)))


def sum_back(measure: str, years: int) -> Column:
    """Within `shown_on` rows: the sum of the copies from that many years ago."""
    return F.sum(F.when(F.col("years_back") == years, F.col(measure)))


def snapshot_before(measure: str) -> Column:
    """On rows per snapshot: the value of the snapshot before."""
    return F.lag(measure).over(Window.orderBy("snapshot_date"))
