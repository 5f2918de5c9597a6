"""The filters every dashboard shares."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.functions.bands import LOW_STOCK
from storelens.plans.models import Star

PUSHED_KEYS = 1000  # keys that a scan is given as a list at most
BROADCAST_KEYS = 1_000_000  # hash keys, some 100 MB, that each executor is given at most


@dataclass(frozen=True)
class Filters:
    """Empty means all. `Filters()` clears every filter."""

    years: tuple[int, ...] = ()
    quarters: tuple[int, ...] = ()
    start: dt.date | None = None
    end: dt.date | None = None
    stores: tuple[str, ...] = ()
    categories: tuple[str, ...] = ()
    brands: tuple[str, ...] = ()
    statuses: tuple[str, ...] = ()
    staff: tuple[str, ...] = ()
    # "order": the store that took the order; "staff": the store its staff member belongs to
    store_scope: str = "order"
    snapshot: dt.date | None = None
    threshold: int = LOW_STOCK
    active_only: bool = True
    # what `resolved` has looked up: a key column, the names it is for, and the keys
    keys: tuple[tuple[str, tuple, tuple[str, ...]], ...] = ()
    # key columns, and the names, with more keys than a list holds and few enough to broadcast
    broadcast: tuple[tuple[str, tuple], ...] = ()

    @classmethod
    def first_load(cls, today: dt.date) -> Filters:
        """What a dashboard shows when it opens: the current year, all stores."""
        return cls(years=(today.year,))

    def without_entities(self) -> Filters:
        """The same period and status over all stores and products."""
        return replace(self, stores=(), categories=(), brands=())

    def without_period(self) -> Filters:
        return replace(self, years=(), quarters=(), start=None, end=None)

    @property
    def has_period(self) -> bool:
        return bool(self.years or self.quarters or self.start or self.end)

    def period(self, day: Column) -> Column | None:
        """The period as date ranges, which reach the Parquet scan; a quarter without a year
        has no range and stays a predicate."""
        parts = []
        if self.years:
            ranges = [
                day.between(F.lit(first), F.lit(last))
                for year in self.years
                for first, last in self._ranges(year)
            ]
            parts.append(reduce(Column.__or__, ranges))
        elif self.quarters:
            parts.append(F.quarter(day).isin(*self.quarters))
        if self.start:
            parts.append(day >= F.lit(self.start))
        if self.end:
            parts.append(day <= F.lit(self.end))
        return reduce(Column.__and__, parts) if parts else None

    def _ranges(self, year: int) -> list[tuple[dt.date, dt.date]]:
        if not self.quarters:
            return [(dt.date(year, 1, 1), dt.date(year, 12, 31))]
        ranges = []
        for quarter in self.quarters:
            after = dt.date(year + quarter // 4, quarter * 3 % 12 + 1, 1)
            ranges.append((dt.date(year, quarter * 3 - 2, 1), after - dt.timedelta(days=1)))
        return ranges

    def _in_period(self, fact: DataFrame, years_back: tuple[int, ...] = ()) -> DataFrame:
        """Rows in the period or, for comparisons, the same period up to some years earlier."""

        def at(column: str) -> Column:
            days = [self.period(F.add_months(F.col(column), 12 * n)) for n in years_back]
            return reduce(Column.__or__, [self.period(F.col(column)), *days])

        if not self.has_period:
            return fact
        fact = fact.where(at("order_date"))
        months = self._months(years_back)
        if "order_month" in fact.columns and months is not None:
            fact = fact.where(months)
        return fact

    def _months(self, years_back: tuple[int, ...]) -> Column | None:
        """The months that the period and those it is compared with can touch, to skip folders of
        a stored fact."""
        month, parts = F.col("order_month"), []
        if self.years:
            years = {year - n for year in self.years for n in (0, *years_back)}
            ranges = [
                month.between(F.lit(first), F.lit(last.replace(day=1)))
                for year in sorted(years)
                for first, last in self._ranges(year)
            ]
            parts.append(reduce(Column.__or__, ranges))
        elif self.quarters:
            parts.append(F.quarter(month).isin(*self.quarters))
        if self.start:
            earliest = dt.date(self.start.year - max(years_back, default=0), self.start.month, 1)
            parts.append(month >= F.lit(earliest))
        if self.end:
            parts.append(month <= F.lit(self.end.replace(day=1)))
        return reduce(Column.__and__, parts) if parts else None

    def resolved(self, star: Star, most: int = PUSHED_KEYS) -> Filters:
        """The same filters with the keys of the chosen names looked up, so that the fact's scan
        gets them as lists and skips the row groups without them.

        This runs a lookup in each dimension that is filtered. Of more than `most` keys nothing is
        kept: the fact then meets them in a join, as without this, and is not shuffled for it where
        there are at most BROADCAST_KEYS.
        """
        wanted = {}
        if self.stores and self.store_scope == "order":
            wanted["dim_store_sk"] = self._stores(star)
        if self.categories or self.brands:
            wanted["dim_product_sk"] = self._products(star)
        if self._by_staff:
            wanted["dim_staff_sk"] = self._staff(star)
        found, broadcast = [], []
        for key, rows in wanted.items():
            values = [row[0] for row in rows.select(key).distinct().limit(most + 1).collect()]
            if len(values) <= most:
                found.append((key, self._names(key), tuple(sorted(values))))
            elif rows.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
                broadcast.append((key, self._names(key)))
        return replace(self, keys=tuple(found), broadcast=tuple(broadcast))

    def _names(self, key: str) -> tuple:
        """What a key's list depends on; with other names it no longer holds."""
        if key == "dim_product_sk":
            return self.categories, self.brands
        return (self.stores,) if key == "dim_store_sk" else (self.staff, self.stores, self.store_scope)

    def _with_keys(self, fact: DataFrame, key: str, rows: Callable[[], DataFrame]) -> DataFrame:
        """Rows of the fact with a key that is among `rows`."""
        known = [values for column, names, values in self.keys if (column, names) == (key, self._names(key))]
        if known:
            # no key at all is a filter too
            return fact.where(F.col(key).isin(*known[0]) if known[0] else F.lit(False))
        chosen = rows().select(key)
        if (key, self._names(key)) in self.broadcast:
            chosen = F.broadcast(chosen)
        return fact.join(chosen, key, "left_semi")

    @property
    def _by_staff(self) -> bool:
        return bool(self.staff or (self.stores and self.store_scope == "staff"))

    def _staff(self, star: Star) -> DataFrame:
        staff = star("dim_staff")
        if self.staff:
            staff = staff.where(F.col("full_name").isin(*self.staff))
        if self.stores and self.store_scope == "staff":
            own = self._stores(star).select("store_id")
            staff = staff.join(own, "store_id", "left_semi")
        return staff

    def _stores(self, star: Star) -> DataFrame:
        return star("dim_store").where(F.col("store_name").isin(*self.stores))

    def _products(self, star: Star) -> DataFrame:
        products = star("dim_product")
        if self.categories:
            products = products.where(F.col("category_name").isin(*self.categories))
        if self.brands:
            products = products.where(F.col("brand_name").isin(*self.brands))
        return products.select("dim_product_sk")

    def sales(self, star: Star, years_back: tuple[int, ...] = ()) -> DataFrame:
        """fct_sales under the filters. Names are looked up in the dimension first; the fact
        meets only the keys that are left."""
        fact = self._in_period(star("fct_sales"), years_back)
        if self.statuses:
            fact = fact.where(F.col("order_status_label").isin(*self.statuses))
        if self.stores and self.store_scope == "order":
            fact = self._with_keys(fact, "dim_store_sk", lambda: self._stores(star))
        if self.categories or self.brands:
            fact = self._with_keys(fact, "dim_product_sk", lambda: self._products(star))
        if self._by_staff:
            fact = self._with_keys(fact, "dim_staff_sk", lambda: self._staff(star))
        return fact

    def inventory(self, star: Star, history: bool = False) -> DataFrame:
        """The chosen snapshot, the newest by default, or all of them."""
        if history or self.snapshot:
            fact = star("fct_inventory_history")
        else:
            fact = star("fct_inventory")
        if self.snapshot:
            fact = fact.where(F.col("snapshot_date") == F.lit(self.snapshot))
        if self.stores:
            fact = self._with_keys(fact, "dim_store_sk", lambda: self._stores(star))
        if self.categories or self.brands:
            fact = self._with_keys(fact, "dim_product_sk", lambda: self._products(star))
        return fact

    def daily_inventory(self, star: Star) -> DataFrame | None:
        """The sums kept per date, store, brand and category, under the same filters."""
        sums = star.daily_inventory()
        if sums is None:
            return None
        sums = sums.drop("snapshot_date") if not self.snapshot else sums.where(F.col("snapshot_date") == F.lit(self.snapshot))
        if self.stores:
            sums = sums.join(self._stores(star).select("dim_store_sk"), "dim_store_sk", "left_semi")
        if self.categories or self.brands:
            keys = star("dim_product").join(self._products(star), "dim_product_sk", "left_semi")
            pairs = keys.select(F.col("brand_id").alias("_brand"), F.col("category_id").alias("_category"))
            same = sums.brand_id.eqNullSafe(pairs._brand) & sums.category_id.eqNullSafe(pairs._category)
            sums = sums.join(pairs, same, "left_semi")
        return sums


ALL = Filters()
