"""Totals next to their parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def whole(groups: DataFrame) -> DataFrame:
    """The same rows, behind a condition that always holds and reads every column.

    Each use of an aggregated frame is cut to the columns it needs. Uses that differ in those
    scan, join and shuffle the fact anew; of the whole rows they all share one aggregation.
    """
    return groups.where(F.xxhash64(*groups.columns) % 2 < 2)


def total_of(groups: DataFrame, measure: str) -> Column:
    """The sum of a measure over all groups, as a scalar subquery.

    No window without a partition and no join: the subquery sums on the executors. It counts the
    other columns too, which keeps its plan the same as the one it is used in, so that Spark
    reuses that plan's last shuffle and the fact is scanned once.
    """
    others = [F.count(c).alias(c) for c in groups.columns if c != measure]
    totals = groups.agg(F.struct(F.sum(measure).alias("_total"), *others))
    return totals.scalar().getField("_total")
