import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from storelens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


DAY1, DAY2 = dt.date(2018, 3, 1), dt.date(2018, 3, 31)

# A shop small enough to check by hand, with the cases that go wrong easily: a guest order (3), an
# order of an unknown customer (4), an unknown status (5), a product with unknown brand and
# category (3), a NULL and an absent manager, discounts of 0 and 1, brands tied on revenue, and a
# stock at every alert limit.
ROWS = {
    "brands": [(1, " Trek "), (2, "Surly")],
    "categories": [(1, " Road "), (2, "Kids")],
    "products": [
        (1, " Alpha ", 1, 1, 2018, 100),
        (2, "Beta", 2, 2, 2017, 50),
        (3, "Gamma", 999, 999, None, 10),
    ],
    "stores": [
        (1, " North ", " ", " N@x.com ", "", "Town", "ca", "1"),
        (2, "South", "5", "S@x.com", "Road", "City", " tx ", ""),
    ],
    "staffs": [
        (1, " Ann ", "Boss", " A@X.com", " ", 1, 1, None),
        (2, "Bob", " Seller", "b@x.com", "5", 1, 1, 1),
        (3, "Cid", "Gone", "c@x.com", "6", 0, 2, 999),
    ],
    "customers": [
        (1, " Eve ", " Stone ", " E@X.Com ", " ", "", "Town", " ca ", "1"),
        (2, "Max", None, "m@x.com", "5", "Road", " ", "tx", " "),
    ],
    "orders": [
        (1, 1, 4, dt.date(2016, 2, 29), None, dt.date(2016, 3, 2), 1, 2),
        (2, 1, 4, dt.date(2017, 2, 28), None, dt.date(2017, 3, 2), 1, 2),
        (3, None, 1, dt.date(2018, 3, 5), None, None, 2, 3),
        (4, 999999, 3, dt.date(2018, 3, 6), None, None, 2, 1),
        (5, 2, 5, dt.date(2018, 3, 7), None, None, 1, 1),
    ],
    "order_items": [
        (1, 1, 1, 1, 100, 0),
        (1, 2, 2, 2, 50, 0),
        (2, 1, 1, 2, 100, 0.5),
        (3, 1, 2, 2, 50, 0),
        (4, 1, 3, 5, 10, 1),
        (5, 1, 3, 1, 10, 0.1),
    ],
    "stocks": [
        (1, 1, None, DAY1),
        (2, 1, 40, DAY1),
        (1, 1, None, DAY2),
        (1, 2, 0, DAY2),
        (1, 3, 2, DAY2),
        (2, 1, 3, DAY2),
        (2, 2, 5, DAY2),
        (2, 3, 6, DAY2),
    ],
}


class Shop:
    """Source tables out of `ROWS`, with changes per table."""

    def __init__(self, spark, **changes):
        self.spark = spark
        self.rows = {**ROWS, **changes}

    def history(self, name):
        from storelens.sources.schemas import TABLES

        table = TABLES[name]
        names = [column for column, _ in table.columns]
        extra = ["ingestion_date"] if name == "stocks" else []
        strings = ", ".join(f"{c} string" for c in [*names, *extra])
        rows = [tuple(None if v is None else str(v) for v in row) for row in self.rows[name]]
        df = self.spark.createDataFrame(rows, strings)
        if extra:
            df = df.withColumn("ingestion_date", df.ingestion_date.cast("date"))
        return table.conform(df, *extra)

    def latest(self, name):
        from storelens.operators.loads import latest_full_load

        return latest_full_load(self.history(name)) if name == "stocks" else self.history(name)


@pytest.fixture
def shop(spark):
    return Shop(spark)


@pytest.fixture
def star(shop):
    from storelens.plans.models import Star

    return Star(shop)


def rows(df, *columns):
    chosen = df.select(*columns) if columns else df
    return [tuple(row) for row in chosen.collect()]


def plan_of(df):
    """The final physical plan, after a run."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("+- == Initial Plan ==")[0]


def count_in(plan, text):
    return plan.count(text)
