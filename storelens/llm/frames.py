"""Helpers shared by the operators: texts through Arrow, scratch tables, bounded settings."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.llm.bytewords import PIECE_BYTES, pieces
from storelens.session import scratch_path

TEXT = "__text"
# Rows at a time in the Parquet reader and on the way to Python. Their buffers hold whole texts, in
# every running task, so their default of some thousand rows more costs tens of MB each.
BATCH_ROWS = {"spark.sql.parquet.columnarReaderBatchSize": "1024", "spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}


def text_column(df: DataFrame, name: str) -> Column:
    """The column as string; void and other types are cast, so a table of nulls works."""
    return F.col(f"`{name}`").cast("string")


def bound_batches(spark: SparkSession) -> None:
    """Has the session read texts in small batches, unless it has settings of its own."""
    for key, rows in BATCH_ROWS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, rows)


def map_texts(
    df: DataFrame,
    text: str,
    keep: Sequence[str],
    fields: Sequence[T.StructField],
    function: Callable[[list[bytes]], dict[str, Iterable]],
    limit: int = PIECE_BYTES,
) -> DataFrame:
    """One row per row of `df`: the columns `keep` and `fields`, which `function` returns.

    `function` gets the UTF-8 bytes of about `limit` bytes of rows at a time and returns a list or
    array per field. A kept column with the name of a field gives way to it.
    """
    bound_batches(df.sparkSession)
    names = {f.name for f in fields}
    kept = [k for k in keep if k not in names]
    body = TEXT if TEXT not in kept else f"{TEXT}_"
    source = df.select(*(F.col(f"`{k}`") for k in kept), text_column(df, text).alias(body))
    schema = T.StructType([source.schema[k] for k in kept] + list(fields))

    def run(batches):
        for batch in batches:
            for part, texts in pieces(batch, body, limit):
                made = function(texts)
                arrays = [part.column(i) for i in range(len(kept))]
                arrays += [_array(made[f.name], f.dataType) for f in fields]
                yield pa.RecordBatch.from_arrays(arrays, names=[*kept, *(f.name for f in fields)])

    return source.mapInArrow(run, schema)


def _array(values, kind: T.DataType) -> pa.Array:
    return values if isinstance(values, pa.Array) else pa.array(values, type=arrow_type(kind))


def arrow_type(kind: T.DataType) -> pa.DataType:
    simple = {
        "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
        "string": pa.string(), "binary": pa.binary(),
    }
    if isinstance(kind, T.ArrayType):
        return pa.list_(arrow_type(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([(f.name, arrow_type(f.dataType)) for f in kind])
    return simple[kind.simpleString()]


def field(name: str, kind: str) -> T.StructField:
    return T.StructField(name, T._parse_datatype_string(kind))


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared folder and read back, so that they are computed once."""
    spark = df.sparkSession
    bound_batches(spark)
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The rows with columns named by place, and those names: no added column can clash with one."""
    names = [f"__{k}" for k in range(len(df.columns))]
    return df.toDF(*names), dict(zip(df.columns, names))
