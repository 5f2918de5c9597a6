"""The jobs: land the source tables, build the models, check them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.operators.quality import ChecksFailed, failed_checks, failure_of, run_checks
from storelens.plans.layout import laid_out
from storelens.plans.models import (
    GOLD,
    LAID_OUT,
    NOT_STORED,
    STAGED,
    LandedTables,
    Sources,
    StoredStar,
    levels,
    model_path,
)
from storelens.plans.suite import SUITE
from storelens.sources import raw, versions
from storelens.sources.schemas import PRODUCTION_TABLES, SALES_TABLES, SourceTable
from storelens.streaming.snapshots import HISTORY, update_history

Reader = Callable[[SourceTable], DataFrame]

# Fixed value: the reference builds with as many threads.
JOBS_AT_ONCE = 4


def _at_once(job: Callable, items: Iterable) -> None:
    """Submit independent Spark jobs from a few threads; the first failure is raised."""
    run = inheritable_thread_target(SparkSession.active())(job)
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        for done in [pool.submit(run, item) for item in items]:
            done.result()


def ingest(
    reader: Reader, tables: Iterable[SourceTable], root: str, load: raw.Load | None = None
) -> raw.Load:
    """Land each table whole. The tables do not depend on one another, so a few are under way
    at a time and a small one does not keep the cluster waiting."""
    load = load or raw.Load.today()
    _at_once(lambda table: raw.write_snapshot(reader(table), root, table, load), tables)
    return load


def ingest_sales(reader: Reader, root: str, load: raw.Load | None = None) -> raw.Load:
    return ingest(reader, SALES_TABLES, root, load)


def ingest_production(reader: Reader, root: str, load: raw.Load | None = None) -> raw.Load:
    return ingest(reader, PRODUCTION_TABLES, root, load)


def write_model(df: DataFrame, root: str, name: str) -> str:
    """Write one model, as `compute` or `laid_out` of a star gives it, to a new version, which is not
    current yet."""
    version = versions.new_version()
    laid_out(df, name, in_order=name in LAID_OUT).parquet(versions.version_path(model_path(root, name), version))
    return version


def publish_model(spark: SparkSession, root: str, name: str, version: str) -> None:
    """Make a version current. The one before it stays for those who are reading it."""
    path = model_path(root, name)
    versions.publish(spark, path, version)
    versions.drop_old_versions(spark, path)


BUILD_ORDER = [*STAGED, *GOLD]


def build_inputs(check: bool = True) -> dict[str, set[str]]:
    """The stored models that each model needs: those it reads and, if it is checked, those its
    keys refer to."""
    inputs: dict[str, set[str]] = {name: set() for name in STAGED}
    for name, model in GOLD.items():
        inputs[name] = set(model.inputs) - set(NOT_STORED)
    for c in SUITE if check else ():
        if c.parent:
            inputs[c.model].add(c.parent)
    return inputs


def build_warehouse(
    sources: Sources, root: str, check: bool = True, **spine: dt.date
) -> StoredStar:
    """Write the models in the order of their inputs. Each reads the written ones before it, so
    nothing is computed twice and a lost executor costs only its own tasks.

    A model is written aside, checked, and only then made current. If a check fails, the version
    before stays current, and what needs the model is not built; everything else is. The error
    that tells of it comes last.
    """
    stored = StoredStar(sources, root, **spine)
    inputs = build_inputs(check)
    stopped: dict[str, list[str]] = {}
    for level in levels(inputs):
        for name in level:
            behind = sorted(inputs[name] & set(stopped))
            if behind:
                stopped[name] = [f"{name}: not built, it needs {', '.join(behind)}"]
        due = [name for name in level if name not in stopped]
        made: dict[str, str] = {}

        def write(name: str, made: dict[str, str] = made) -> None:
            if name == HISTORY and keeps_records(sources):
                update_history(
                    stored.spark, sources.root, stored("stg_products"), model_path(root, HISTORY)
                )
            else:
                made[name] = write_model(stored.compute(name), root, name)

        _at_once(write, due)
        for name, version in made.items():
            stored.show(name, version)
        checks = [c for c in SUITE if check and c.model in made]
        for row in failed_checks(run_checks(stored, checks)) if checks else ():
            stopped.setdefault(row.model, []).append(failure_of(row))
        for name, version in made.items():
            if name not in stopped:
                publish_model(stored.spark, root, name, version)
            stored.show(name, None)
    if stopped:
        raise ChecksFailed(f"{len(stopped)} models are not current\n" + "\n".join(line for lines in stopped.values() for line in lines))
    return stored


def keeps_records(sources: Sources) -> bool:
    """Whether the sources tell the load of each snapshot date; else the history is written whole."""
    return isinstance(sources, LandedTables) and sources.by == "run"


def landed_catalog(spark: SparkSession, root: str) -> DataFrame:
    """The tables that have landed, in the shape of a database catalog."""
    return (
        raw.read_manifest(spark, root)
        .select(
            F.col("schema").alias("table_schema"),
            F.col("table").alias("table_name"),
            F.lit("BASE TABLE").alias("table_type"),
        )
        .distinct()
    )
