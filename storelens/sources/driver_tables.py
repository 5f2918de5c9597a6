"""The nine source tables derived from TPC-H-like order tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storelens.operators.loads import latest_full_load
from storelens.sources.schemas import TABLES

# Three snapshots of the stock grid.
SNAPSHOT_START = dt.date(2001, 7, 1)
SNAPSHOTS = 3
PART_RANGE = "l_partkey div 10000"
# An order with more lines is numbered in pieces.
LINES_AT_ONCE = 10_000
# Orders are looked through for larger ones by buckets, so a reader counts no more than these.
ORDER_BUCKETS = 1 << 18
# The order of the lines of a piece.
IN_PIECE = ["l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]
BRAND_ID = "cast(split_part(p_brand, '#', 2) as int) as brand_id"


class DriverTables:
    """Source tables below one folder of `*.parquet` inputs."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def latest(self, name: str) -> DataFrame:
        """The newest snapshot. Only stocks has several."""
        table = self.history(name)
        return latest_full_load(table) if name == "stocks" else table

    def history(self, name: str) -> DataFrame:
        extra = ["ingestion_date"] if name == "stocks" else []
        return TABLES[name].conform(getattr(self, name)(), *extra)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def brands(self) -> DataFrame:
        brands = self.read("part").select("p_brand").distinct()
        return brands.selectExpr(BRAND_ID, "'  ' || p_brand || ' ' as brand_name")

    def _types(self) -> DataFrame:
        # The window has no partition, over the distinct part types only: the input's
        # specification fixes those at 150 whatever the number of parts.
        rank = F.dense_rank().over(Window.orderBy("p_type"))
        return (
            self.read("part")
            .select("p_type")
            .distinct()
            .select(rank.cast("int").alias("category_id"), "p_type")
        )

    def categories(self) -> DataFrame:
        return self._types().selectExpr("category_id", "' ' || p_type || ' ' as category_name")

    def products(self) -> DataFrame:
        parts = self.read("part").join(F.broadcast(self._types()), "p_type")
        return parts.selectExpr(
            "p_partkey as product_id",
            "' ' || p_name || ' ' as product_name",
            BRAND_ID,
            "category_id",
            "2014 + p_size % 6 as model_year",
            "cast(p_retailprice as decimal(10,2)) as list_price",
        )

    def stores(self) -> DataFrame:
        return self.read("region").selectExpr(
            "r_regionkey as store_id",
            "' ' || r_name || ' Store ' as store_name",
            "if(r_regionkey % 2 = 0, ' ', '555-010' || r_regionkey) as phone",
            "' store' || r_regionkey || '@example.com ' as email",
            "'' as street",
            "r_name as city",
            "lower(substr(r_name, 1, 2)) as state",
            "'0000' || r_regionkey as zip_code",
        )

    def staffs(self) -> DataFrame:
        suppliers = self.read("supplier").join(
            self.read("nation"), F.col("s_nationkey") == F.col("n_nationkey")
        )
        return suppliers.selectExpr(
            "s_suppkey as staff_id",
            "' First' || s_suppkey || ' ' as first_name",
            "'Last' || s_suppkey as last_name",
            "' STAFF' || s_suppkey || '@Example.com' as email",
            "'' as phone",
            "if(s_suppkey % 10 = 9, 0, 1) as active",
            "n_regionkey as store_id",
            "if(s_suppkey < 3, null, s_suppkey % 3) as manager_id",
        )

    def customers(self) -> DataFrame:
        customers = (
            self.read("customer")
            .join(self.read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        )
        return customers.selectExpr(
            "c_custkey as customer_id",
            "' Cust ' as first_name",
            "split_part(c_name, '#', 2) as last_name",
            "' C' || c_custkey || '@Example.com ' as email",
            "if(c_custkey % 3 = 0, ' ', '555-' || c_custkey) as phone",
            "'' as street",
            "n_name as city",
            "lower(substr(r_name, 1, 2)) as state",
            "cast(10000 + c_nationkey as string) as zip_code",
        )

    def orders(self) -> DataFrame:
        # The number of suppliers is a scalar subquery, so the staff member of an order is a
        # plain equi-join.
        suppliers = self.read("supplier").agg(F.count(F.lit(1))).scalar()
        # Two joins, not one with the joined staff: Spark then knows how small each side is, and
        # orders are not shuffled for it.
        staff = self.read("supplier").selectExpr("s_suppkey as staff_id", "s_nationkey")
        store = self.read("nation").selectExpr("n_nationkey as s_nationkey", "n_regionkey as store_id")
        orders = (
            self.read("orders")
            .withColumn("staff_id", F.col("o_orderkey") % suppliers)
            .withColumn("order_date", F.col("o_orderdate").cast("date"))
        )
        return orders.join(staff, "staff_id").join(store, "s_nationkey").selectExpr(
            "o_orderkey as order_id",
            "if(o_orderkey % 20 = 0, null, o_custkey) as customer_id",
            "case when o_orderkey % 15 = 7 then 3 when o_orderstatus = 'O' then 1 "
            "when o_orderstatus = 'P' then 2 else 4 end as order_status",
            "order_date",
            "date_add(order_date, 7) as required_date",
            "if(o_orderstatus = 'F', date_add(order_date, cast(o_orderkey % 10 as int)), null) "
            "as shipped_date",
            "store_id",
            "staff_id",
        )

    def order_items(self) -> DataFrame:
        return self._items(self._numbered_lines())

    def latest_in_parts(self, name: str) -> list[DataFrame]:
        """As `latest`; order items in two parts, which leave out those without an order.

        Orders of up to `LINES_AT_ONCE` lines are numbered as one group each and lie by order_id, so a
        join with the orders shuffles them no more. The lines of larger ones, mostly none, are a part
        of their own: they lie by pieces, and a join can split them. Both parts need the search for
        large orders, so a query that does not use item_id is better off with `latest`.
        """
        if name != "order_items":
            return [self.latest(name)]
        large = F.broadcast(self._large_orders())
        lines = self.read("lineitem").where(F.col("l_orderkey").isNotNull())
        small = lines.join(large, "l_orderkey", "left_anti")
        parts = [self._numbered_orders(small), self._numbered_lines(only_large=True)]
        return [TABLES[name].conform(self._items(part)) for part in parts]

    def _items(self, numbered: DataFrame) -> DataFrame:
        lines = numbered.join(self.read("part"), F.col("l_partkey") == F.col("p_partkey"))
        return lines.selectExpr(
            "l_orderkey as order_id",
            "item_id",
            "l_partkey as product_id",
            "cast(l_quantity as int) as quantity",
            "cast(p_retailprice as decimal(10,2)) + l_linenumber as list_price",
            "cast(l_discount as decimal(4,2)) as discount",
        )

    @staticmethod
    def _place(numbered: DataFrame, before: Column) -> DataFrame:
        """Lines without an order or a line number are numbered by piece alone."""
        place = F.when(
            F.col("l_orderkey").isNull() | F.col("l_linenumber").isNull(),
            F.col("place_alone").cast("bigint"),
        ).otherwise(before + F.col("place"))
        return numbered.withColumn("item_id", place)

    def _numbered_orders(self, lines: DataFrame) -> DataFrame:
        """Lines with their place in the order, each order numbered as one group."""
        lines = lines.repartition("l_orderkey").withColumn("part_range", F.expr(PART_RANGE))
        in_order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "part_range", *IN_PIECE)
        alone = Window.partitionBy("l_orderkey", "l_linenumber", "part_range").orderBy(*IN_PIECE)
        numbered = lines.withColumn("place", F.row_number().over(in_order)).withColumn(
            "place_alone", F.row_number().over(alone)
        )
        return self._place(numbered, F.lit(0).cast("bigint"))

    def _numbered_lines(self, only_large: bool = False) -> DataFrame:
        """Lines with their place in the order, which a real source would carry.

        An order of up to `LINES_AT_ONCE` lines is numbered as one group. A larger one is numbered
        in pieces (line number, range of parts), each after the sizes of the pieces before it, so
        it is spread over tasks. There is at most one per `LINES_AT_ONCE` lines of the table, which
        is why their keys are broadcast. Keys and sizes come by left joins on keys Spark knows to
        be distinct: it drops the whole numbering from queries that do not use it. Lines without
        an order or a line number are numbered by piece alone.
        """
        piece = ["l_orderkey", "l_linenumber", "part_range"]
        group = ["l_orderkey", "group_line", "group_range"]
        lines = self.read("lineitem").withColumn("part_range", F.expr(PART_RANGE))
        large = F.broadcast(self._large_orders().withColumn("is_large", F.lit(True)))
        in_order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "part_range")
        before = F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
        offsets = (
            lines.join(large, "l_orderkey", "left_semi")
            .groupBy(*piece)
            .agg(F.count(F.lit(1)).alias("size"))
            .withColumn("before", before)
            .groupBy(*[F.col(c).alias(name) for c, name in zip(piece, group)])
            .agg(F.max("before").alias("before"))
        )
        in_pieces = F.col("is_large") | F.col("l_orderkey").isNull()
        # both windows have the grouping and the order of rows of the join behind them: one sort
        in_group = Window.partitionBy(*group).orderBy("l_linenumber", "part_range", *IN_PIECE)
        alone = Window.partitionBy(*group, "l_linenumber", "part_range").orderBy(*IN_PIECE)
        numbered = (
            lines.join(large, "l_orderkey", "inner" if only_large else "left")
            .withColumn("group_line", F.when(in_pieces, F.col("l_linenumber")))
            .withColumn("group_range", F.when(in_pieces, F.col("part_range")))
            .withColumn("place", F.row_number().over(in_group))
            .withColumn("place_alone", F.row_number().over(alone))
            .join(offsets, group, "left")
        )
        return self._place(numbered, F.coalesce("before", F.lit(0)))

    def _large_orders(self) -> DataFrame:
        """Keys of the orders with more than `LINES_AT_ONCE` lines.

        Orders, nearly as many as the lines, would fill the readers' memory. Lines are counted by
        buckets of orders first; only buckets with that many lines can hold such an order, and
        only their lines are shuffled and counted by order.
        """
        lines = (
            self.read("lineitem")
            .select("l_orderkey")
            .where(F.col("l_orderkey").isNotNull())
            .withColumn("bucket", F.pmod(F.xxhash64("l_orderkey"), F.lit(ORDER_BUCKETS)))
        )

        def full(df: DataFrame, key: str) -> DataFrame:
            counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("lines"))
            return counted.where(F.col("lines") > LINES_AT_ONCE).select(key)

        buckets = F.broadcast(full(lines, "bucket"))
        inside = lines.join(buckets, "bucket", "left_semi")
        return full(inside.repartition("l_orderkey"), "l_orderkey")

    def stocks(self) -> DataFrame:
        # The grid is every part at every store on every date: the few store ids are one array
        # value, exploded next to each part, so parts stay where they are read.
        stores = self.read("region").agg(F.collect_set("r_regionkey")).scalar()
        grid = (
            self.read("part")
            .select("p_partkey", F.explode(stores).alias("store_id"))
            .selectExpr("*", f"explode(sequence(0, {SNAPSHOTS - 1})) as k")
        )
        return grid.selectExpr(
            "store_id",
            "p_partkey as product_id",
            "if((p_partkey + store_id) % 50 = 0, null, "
            "(p_partkey * 7 + store_id * 13 + k * 5) % 40) as quantity",
            f"date_add(date '{SNAPSHOT_START}', k) as ingestion_date",
        )
