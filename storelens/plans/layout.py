"""How the stored facts lie in their folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter

# Large facts are stored by time, so a period filter skips whole folders.
PARTITION_BY = {"fct_sales": "order_month", "fct_inventory_history": "snapshot_date"}
# Within a folder rows lie by these keys, so a filter on some stores or products skips row groups
# and pages by their ranges. Keys that no order brings together have Bloom filters, sized for so
# many values in a row group.
CLUSTER_BY = {
    "fct_sales": ("dim_store_sk", "dim_product_sk"),
    "fct_inventory_history": ("dim_store_sk", "dim_product_sk"),
}
BLOOM_VALUES = {
    "fct_sales": {"dim_product_sk": 50_000, "dim_staff_sk": 5_000},
    "fct_inventory_history": {"dim_product_sk": 50_000},
}
# Hash keys are texts of hexadecimal digits: snappy stores them whole, zstd in half the space.
COMPRESSION = "zstd"


def stored_order(name: str) -> tuple[str, ...]:
    """The columns that the rows of a stored fact lie by."""
    return (PARTITION_BY[name], *CLUSTER_BY[name])


def laid_out(df: DataFrame, name: str, in_order: bool = False) -> DataFrameWriter:
    """A writer of a model's rows in its stored layout. `in_order`: the rows of a partition already
    lie in the stored order."""
    if name not in PARTITION_BY:
        return df.write.option("compression", COMPRESSION)
    ordered = df if in_order else df.sortWithinPartitions(*stored_order(name))
    out = ordered.write.partitionBy(PARTITION_BY[name]).option("compression", COMPRESSION)
    for column, values in BLOOM_VALUES[name].items():
        out = out.option(f"parquet.bloom.filter.enabled#{column}", "true")
        out = out.option(f"parquet.bloom.filter.expected.ndv#{column}", str(values))
    return out
