"""Rankings that never gather an unbounded number of rows in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Buckets a doubling of the value is cut into. Values up to 1e28 then fall into 190,000 buckets at
# most, and a bucket holds values that differ by less than a thousandth.
BUCKETS_A_DOUBLING = 1024


def _bucket(value: Column) -> Column:
    """A number that never falls as the value rises."""
    size = F.floor(F.log2(F.abs(value.cast("double")) + 1) * BUCKETS_A_DOUBLING)
    return F.when(value < 0, -size).otherwise(size)


def dense_rank_desc(groups: DataFrame, value: str, out: str, total: str | None = None) -> DataFrame:
    """Dense rank of `value`, largest first, NULL last, over all rows of an aggregated frame, and
    as `total` the sum of `value` over them.

    Distinct values are counted per bucket and ranked within it; only the buckets' counts, bounded
    by the type, meet in one task. A value that very many rows share is one row until the ranks
    are joined back, where the adaptive skew join splits it.
    """
    largest_first = F.col(value).desc_nulls_last()
    totals = [total] if total else []
    values = groups.groupBy(value).agg(F.sum(value).alias("_sum")) if total else groups.select(value).distinct()
    values = values.withColumn("_bucket", _bucket(F.col(value)))
    by_bucket = Window.orderBy(F.col("_bucket").desc_nulls_last())
    earlier = by_bucket.rowsBetween(Window.unboundedPreceding, -1)
    all_buckets = by_bucket.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = (
        values.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_size"), *([F.sum("_sum").alias("_sum")] if total else []))
        .select(
            F.col("_bucket").alias("_of"), F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"),
            *([F.sum("_sum").over(all_buckets).alias(total)] if total else []),
        )
    )
    inside = F.dense_rank().over(Window.partitionBy("_bucket").orderBy(largest_first))
    ranks = (
        values.withColumn("_inside", inside)
        .join(before, F.col("_bucket").eqNullSafe(F.col("_of")))
        .select(
            F.col(value).alias("_value"), (F.col("_before") + F.col("_inside")).alias(out), *totals
        )
    )
    joined = groups.join(ranks, F.col(value).eqNullSafe(F.col("_value")))
    return joined.select(*groups.columns, out, *totals)


def top_with_ties(groups: DataFrame, value: str, n: int = 1) -> DataFrame:
    """The n largest rows and all that tie with the last of them.

    The cut-off is a scalar subquery over a top-n sort, so no ranking of all rows is needed.
    """
    cutoff = groups.orderBy(F.col(value).desc()).limit(n).agg(F.min(value)).scalar()
    return groups.where(F.col(value) >= cutoff)


def top_label(groups: DataFrame, name: str, value: str) -> DataFrame:
    """One row: the name with the largest value, or 'Multiple' when several tie, and the value
    that the winning names add up to."""
    best = top_with_ties(groups, value)
    return best.agg(
        F.when(F.count(F.lit(1)) > 1, "Multiple").otherwise(F.max(name)).alias(name),
        F.sum(value).cast(groups.schema[value].dataType).alias(value),
    )
