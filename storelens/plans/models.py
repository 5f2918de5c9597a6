"""The models of the warehouse and how each is built from the others."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection
from dataclasses import dataclass
from functools import partial
from graphlib import TopologicalSorter
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession

from storelens.operators import dimensions, facts
from storelens.operators.loads import last_run_per_date, latest_full_load, latest_run
from storelens.operators.staging import STAGING
from storelens.plans import model_schemas
from storelens.plans.layout import PARTITION_BY, stored_order
from storelens.sources import raw, versions
from storelens.sources.schemas import TABLES
from storelens.streaming.snapshots import BY_DATE, DAILY_DDL, HISTORY, daily_path

STAGING_LAYER = "staging"
GOLD_LAYER = "common_bs"  # fixed value: folder name of the gold layer


class Sources(Protocol):
    spark: SparkSession

    def latest(self, name: str) -> DataFrame: ...

    def history(self, name: str) -> DataFrame: ...


class LandedTables:
    """Source tables from the raw layer.

    `by="run"` keeps the last load of the newest day, as the manifest has it. `by="date"` keeps
    all rows of the newest day, so two loads on one day give every row twice.
    """

    def __init__(self, spark: SparkSession, root: str, by: str = "run"):
        self.spark = spark
        self.root = root
        self.by = by

    def latest(self, name: str) -> DataFrame:
        landed = raw.scan(self.spark, self.root, TABLES[name])
        if self.by == "date":
            return latest_full_load(landed)
        return latest_run(landed, raw.read_manifest(self.spark, self.root), TABLES[name])

    def history(self, name: str) -> DataFrame:
        landed = raw.scan(self.spark, self.root, TABLES[name])
        if self.by == "date":
            return landed
        return last_run_per_date(
            landed, raw.read_manifest(self.spark, self.root), TABLES[name]
        )


def _latest(name: str) -> Callable[[Sources], DataFrame]:
    return lambda sources: STAGING[name](sources.latest(name))


STAGED: dict[str, Callable[[Sources], DataFrame]] = {
    f"stg_{name}": _latest(name) for name in STAGING
}

@dataclass(frozen=True)
class Model:
    """A model of the gold layer: the models it reads, in the order `build` takes them."""

    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]


GOLD: dict[str, Model] = {
    "dim_customer": Model(("stg_customers",), dimensions.dim_customer),
    "dim_product": Model(("stg_products", "stg_brands", "stg_categories"), dimensions.dim_product),
    "dim_store": Model(("stg_stores",), dimensions.dim_store),
    "dim_staff": Model(("stg_staffs",), dimensions.dim_staff),
    "dim_date": Model(("date_spine",), dimensions.dim_date),
    "fct_sales": Model(("stg_order_items", "stg_orders"), facts.fct_sales),
    "fct_inventory": Model(("stg_stocks", "stg_products"), facts.fct_inventory),
    "fct_inventory_history": Model(
        ("stg_stocks_history", "stg_products"), facts.fct_inventory_history
    ),
}


LAID_OUT: dict[str, Callable[..., DataFrame]] = {
    "fct_sales": partial(facts.fct_sales, by_month=True, in_order=stored_order("fct_sales")),
    "fct_inventory_history": partial(
        facts.fct_inventory_history, by_snapshot=True, in_order=stored_order("fct_inventory_history")
    ),
}


# Inputs of one model only.
NOT_STORED = ("date_spine", "stg_stocks_history")


class Star:
    """All models by name, computed from the sources when an action needs them."""

    def __init__(
        self,
        sources: Sources,
        spine_start: dt.date = dimensions.SPINE_START,
        spine_end: dt.date = dimensions.SPINE_END,
    ):
        self.spark = sources.spark
        self.sources = sources
        self.spine = (spine_start, spine_end)
        self._built: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def _build(self, name: str) -> DataFrame:
        if name == "date_spine":
            return dimensions.date_spine(self.spark, *self.spine)
        if name == "stg_stocks_history":
            return STAGING["stocks"](self.sources.history("stocks"))
        if name in STAGED:
            return STAGED[name](self.sources)
        return GOLD[name].build(*map(self, GOLD[name].inputs))

    def laid_out(self, name: str) -> DataFrame:
        """A large fact as it is to be stored, in its stored order: all its columns are needed, so its
        lines may come in the parts in which its sources have them."""
        return LAID_OUT[name](*map(self._staged_in_parts, GOLD[name].inputs))

    def _staged_in_parts(self, name: str) -> DataFrame | list[DataFrame]:
        in_parts = getattr(self.sources, "latest_in_parts", None)
        if name != "stg_order_items" or in_parts is None:
            return self(name)
        return [STAGING["order_items"](part) for part in in_parts("order_items")]

    def daily_inventory(self) -> DataFrame | None:
        """Inventory per date, store, brand and category, where such sums are kept."""
        return None


def levels(inputs: dict[str, Collection[str]]) -> list[list[str]]:
    """Models in groups such that each needs only models of the groups before. A cycle, or a model
    that is needed and not there, is an error."""
    unknown = sorted({i for needed in inputs.values() for i in needed} - set(inputs))
    if unknown:
        raise ValueError(f"no such models: {', '.join(unknown)}")
    sorter = TopologicalSorter(inputs)
    sorter.prepare()
    groups = []
    while sorter.is_active():
        groups.append(sorted(sorter.get_ready()))
        sorter.done(*groups[-1])
    return groups


def layer_of(name: str) -> str:
    return STAGING_LAYER if name.startswith("stg_") else GOLD_LAYER


def model_path(root: str, name: str) -> str:
    return f"{root}/{layer_of(name)}/{name}"


class StoredStar(Star):
    """Models read back from the warehouse folder, each in its current version or, while they are
    built, in one that is not yet current."""

    def __init__(self, sources: Sources, root: str, **spine: dt.date):
        super().__init__(sources, **spine)
        self.root = root
        self._unpublished: dict[str, str] = {}

    def compute(self, name: str) -> DataFrame:
        """One model as it is to be stored, from the stored models before it."""
        if name in LAID_OUT:
            return self.laid_out(name)
        return super()._build(name)

    def _staged_in_parts(self, name: str) -> DataFrame:
        return self(name)  # it is stored

    def show(self, name: str, version: str | None) -> None:
        """From now on show a version that is not current; None goes back to the current one."""
        self._built.pop(name, None)
        self._unpublished.pop(name, None)
        if version is not None:
            self._unpublished[name] = version

    def _build(self, name: str) -> DataFrame:
        if name in NOT_STORED:
            return self.compute(name)
        path, columns = model_path(self.root, name), model_schemas.ddl(name)
        if name in self._unpublished:
            folder = versions.version_path(path, self._unpublished[name])
            return self.spark.read.schema(columns).parquet(folder)
        _, state = versions.read_state(self.spark, path)
        if state and versions.WHOLE not in state:
            return versions.current_parts(self.spark, path, state, columns, PARTITION_BY[name])
        return versions.current(self.spark, path, columns)

    def daily_inventory(self) -> DataFrame | None:
        path = model_path(self.root, HISTORY)
        _, state = versions.read_state(self.spark, path)
        if not state or versions.WHOLE in state:
            return None
        return versions.current_parts(self.spark, daily_path(path), state, DAILY_DDL, BY_DATE)
