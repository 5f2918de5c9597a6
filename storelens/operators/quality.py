"""Declarative data checks.

Each check gives one row: model, column_name, test, failing_rows, status. The failing rows are
 - unique: values that occur more than once,
 - not_null: rows without a value,
 - accepted_values: distinct values outside the list,
 - relationships: rows whose key has no parent.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

Ref = Callable[[str], DataFrame]

UNIQUE = "unique"
NOT_NULL = "not_null"
ACCEPTED_VALUES = "accepted_values"
RELATIONSHIPS = "relationships"

# Buckets of a check's keys; the numbers of those with repeated hashes are broadcast.
KEY_BUCKETS = 1 << 14


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    test: str
    values: tuple[int, ...] = ()
    parent: str = ""


def _rows(df: DataFrame, checks: list[Check], failing: list[str]) -> DataFrame:
    """One result row per check out of one row that holds all counts."""
    rows = ", ".join(
        f"'{c.model}', '{c.column}', '{c.test}', {count}" for c, count in zip(checks, failing)
    )
    names = "model, column_name, test, failing_rows"
    return df.selectExpr(f"stack({len(checks)}, {rows}) as ({names})")


def _counts(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All null and value-list checks of a model in one scan of the columns they name."""

    def count(check: Check) -> str:
        if check.test == NOT_NULL:
            return f"count_if({check.column} is null)"
        listed = ", ".join(map(str, check.values))
        return f"count(distinct case when {check.column} not in ({listed}) then {check.column} end)"

    names = [f"c{i}" for i in range(len(checks))]
    counts = df.selectExpr(*[f"{count(c)} as {name}" for c, name in zip(checks, names)])
    return _rows(counts, checks, names)


def _by_check(looked_at: dict[str, list[str]], ref: Ref) -> DataFrame:
    """A row for each value that is looked at: each model is scanned once for all its checks."""
    entries = [
        ref(model).selectExpr(f"inline(array({', '.join(structs)}))")
        for model, structs in looked_at.items()
    ]
    return reduce(DataFrame.unionByName, entries).where(F.col("key").isNotNull())


def _found(per_check: DataFrame, checks: list[Check]) -> DataFrame:
    """A result row per check from the `failing` counts of those that have any."""
    found = per_check.selectExpr("map_from_entries(collect_list(struct(check, failing))) as found")
    failing = [f"coalesce(try_element_at(found, {i}), 0L)" for i in range(len(checks))]
    return _rows(found, checks, failing)


def _hash(key: str) -> Column:
    return F.xxhash64(key)


def _unique_checks(ref: Ref, checks: list[Check]) -> DataFrame:
    """Unique checks in one grouping on (check, key).

    Unique keys are as many as the rows: they would fill the readers' memory and shrink nothing
    there, and as texts they are wide. So only their hashes are shuffled, and counted in the
    partitions that come out. A key can repeat only where a hash does: the keys of the buckets with
    repeated hashes, none in a sound load, are then counted themselves.
    """
    looked_at: dict[str, list[str]] = {}
    for i, check in enumerate(checks):
        entry = f"struct({i} as check, cast({check.column} as string) as key)"
        looked_at.setdefault(check.model, []).append(entry)
    entered = _by_check(looked_at, ref).withColumn("hash", _hash("key"))
    in_bucket = F.pmod("hash", F.lit(KEY_BUCKETS)).alias("bucket")

    def counted(df: DataFrame, key: str) -> DataFrame:
        return df.repartition("check", key).groupBy("check", key).agg(F.count(F.lit(1)).alias("rows"))

    # a row per check, with at most KEY_BUCKETS numbers
    repeated = (
        counted(entered.select("check", "hash"), "hash")
        .groupBy("check")
        .agg(F.collect_set(F.when(F.col("rows") > 1, in_bucket)).alias("buckets"))
    )
    buckets = repeated.select("check", F.explode("buckets").alias("bucket"))
    doubtful = entered.select("check", "key", in_bucket).join(
        F.broadcast(buckets), ["check", "bucket"], "left_semi"
    )
    per_check = counted(doubtful, "key").groupBy("check").agg(F.expr("count_if(rows > 1)").alias("keys"))
    failing = F.when(F.size("buckets") > 0, F.coalesce("keys", F.lit(0))).otherwise(0)
    return _found(repeated.join(per_check, "check", "left").select("check", failing.alias("failing")), checks)


def _relationship_checks(ref: Ref, checks: list[Check]) -> DataFrame:
    """Relationships checks in one grouping on (check, key).

    Each model is scanned once, for the checked columns and for those that are parents of others.
    Rows are counted per key where they are read, so a key that fills a third of a fact is one
    row by the time it is shuffled. An orphan has rows and no parent.
    """
    looked_at: dict[str, list[str]] = {}
    for i, check in enumerate(checks):
        key = f"{i} as check, cast({check.column} as string) as key"
        for model, rows, is_parent in ((check.model, "1L", "false"), (check.parent, "0L", "true")):
            entry = f"struct({key}, {rows} as rows, {is_parent} as is_parent)"
            looked_at.setdefault(model, []).append(entry)
    keys = (
        _by_check(looked_at, ref)
        .groupBy("check", "key")
        .agg(F.sum("rows").alias("rows"), F.max("is_parent").alias("has_parent"))
    )
    per_check = (
        keys.where(~F.col("has_parent")).groupBy("check").agg(F.sum("rows").alias("failing"))
    )
    return _found(per_check, checks)


def run_checks(ref: Ref, checks: Iterable[Check]) -> DataFrame:
    ordered = sorted(checks, key=lambda c: c.model)
    counted = [c for c in ordered if c.test in (NOT_NULL, ACCEPTED_VALUES)]
    keyed = [c for c in ordered if c.test in (UNIQUE, RELATIONSHIPS)]
    parts = [
        _counts(ref(model), list(group))
        for model, group in groupby(counted, key=lambda c: c.model)
    ]
    # unique keys stay as many as the rows; apart from them, foreign keys shrink where they are read
    for test, found in ((UNIQUE, _unique_checks), (RELATIONSHIPS, _relationship_checks)):
        if of_test := [c for c in keyed if c.test == test]:
            parts.append(found(ref, of_test))
    status = F.when(F.col("failing_rows") == 0, "pass").otherwise("fail")
    return reduce(DataFrame.unionByName, parts).withColumn("status", status)


class ChecksFailed(Exception):
    """At least one data check found failing rows."""


def failed_checks(results: DataFrame) -> list[Row]:
    """The checks that failed. There is one row per check, so the rows are few."""
    return results.where(F.col("status") == "fail").orderBy("model", "column_name", "test").collect()


def failure_of(row: Row) -> str:
    return f"{row.model}.{row.column_name} {row.test}: {row.failing_rows}"


def require_pass(results: DataFrame) -> None:
    """Raise when a check failed."""
    rows = failed_checks(results)
    if rows:
        raise ChecksFailed(f"{len(rows)} checks failed\n" + "\n".join(map(failure_of, rows)))
