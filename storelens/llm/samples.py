"""Bounded samples of labelled rows, and the split that keeps some labels for measuring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 4
HELD_OUT = 2


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row's label is never learned from; a null id is not held out."""
    fold = F.crc32(F.col(f"`{doc_id}`").cast("string")) % FOLDS
    return F.coalesce(fold == HELD_OUT, F.lit(False))


def learnable(labels: DataFrame, label: str, doc_id: str = "doc_id") -> DataFrame:
    """One row (doc_id, label 0 or 1) per labelled id outside the held-out fold.

    Null ids and labels are left out; an id with different labels counts as 1.
    """
    rows = labels.where(~held_out(doc_id) & F.col(label).isNotNull() & F.col(doc_id).isNotNull())
    one = F.max(F.when(F.col(label) > 0, 1).otherwise(0))
    return rows.groupBy(F.col(doc_id).alias("doc_id")).agg(one.alias("label"))


def some_of(rows: DataFrame, count: int, seed: int) -> DataFrame:
    """`count` rows at most, the same ones each time, by the hashes of their ids."""
    return rows.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(count)
