"""Stored tables in versioned folders, and a log that says which of them are current.

    <table>/v=<version>/…               written whole, then never touched
    <table>/_commits/000000000007       the state after seven commits, a small JSON object

A writer fills a new folder and then adds the next entry of the log. An entry can be added once
only, so a writer that meets one more recent than it has read looks at it and tries the next
number. Until the entry is there readers see the folders before it, whole; a writer that dies in
between leaves a folder that nobody reads. The state names the current folder of each part of a
table: most have one part, a table by snapshot date has one per date.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession

from storelens.session import create_once, list_names, read_text, remove_folder

COMMITS = "_commits"
WHOLE = ""  # the part of a table that has one


@dataclass(frozen=True)
class Part:
    """The folder a part is in, none if it has no rows, and what it was made from."""

    version: str | None
    made_from: str = ""


State = dict[str, Part]


class NotPublished(Exception):
    """A table without a current version."""


def new_version() -> str:
    return uuid.uuid4().hex


def version_path(table: str, version: str) -> str:
    return f"{table}/v={version}"


def _entries(spark: SparkSession, table: str) -> list[int]:
    return [int(name) for name in list_names(spark, f"{table}/{COMMITS}") if name.isdigit()]


def _entry_path(table: str, number: int) -> str:
    return f"{table}/{COMMITS}/{number:012d}"


def _state(spark: SparkSession, table: str, number: int) -> State:
    stated = json.loads(read_text(spark, _entry_path(table, number)))
    return {name: Part(**part) for name, part in stated.items()}


def read_state(spark: SparkSession, table: str) -> tuple[int, State]:
    """The number of the last commit and the state after it; 0 and nothing before the first."""
    numbers = _entries(spark, table)
    return (numbers[-1], _state(spark, table, numbers[-1])) if numbers else (0, {})


def commit(spark: SparkSession, table: str, change: Callable[[State], State]) -> State:
    """Adds an entry with the changed state. `change` is asked again if another came first."""
    while True:
        number, state = read_state(spark, table)
        changed = change(state)
        text = json.dumps({name: asdict(part) for name, part in sorted(changed.items())})
        if create_once(spark, _entry_path(table, number + 1), text):
            return changed


def publish(spark: SparkSession, table: str, version: str) -> None:
    """Makes one folder the whole table."""
    commit(spark, table, lambda _: {WHOLE: Part(version)})


def current(spark: SparkSession, table: str, ddl: str) -> DataFrame:
    """The whole table in its current version."""
    _, state = read_state(spark, table)
    if WHOLE not in state:
        raise NotPublished(table)
    return spark.read.schema(ddl).parquet(version_path(table, state[WHOLE].version))


def current_parts(spark: SparkSession, table: str, state: State, ddl: str, by: str) -> DataFrame:
    """The parts of a table whose folders are partitioned by `by`, as a state has them."""
    paths = [f"{version_path(table, p.version)}/{by}={name}" for name, p in sorted(state.items()) if p.version]
    if not paths:
        return spark.createDataFrame([], ddl)
    read = spark.read.schema(ddl).option("basePath", table).parquet(*paths)
    return read.drop("v")


def drop_old_versions(spark: SparkSession, table: str, keep: int = 2, also: tuple[str, ...] = ()) -> None:
    """Deletes the folders that only older entries than the last `keep` name, and those entries.

    Folders that no entry names are left alone: another writer may be filling them. `also` are
    tables whose folders go by the same versions.
    """
    numbers = _entries(spark, table)
    used = {p.version for n in numbers[-keep:] for p in _state(spark, table, n).values()}
    for number in numbers[:-keep]:
        for part in _state(spark, table, number).values():
            if part.version and part.version not in used:
                for folder in (table, *also):
                    remove_folder(spark, version_path(folder, part.version))
        remove_folder(spark, _entry_path(table, number))
