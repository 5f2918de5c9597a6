"""Token-id files: documents' ids in id order, Simple-8b coded, written and read back by Spark.

A table of segments, each a self-contained piece of the format in `simple8b`. Spark's writer puts
them into the shared store, so executors need no file system of their own. Segments follow the
ids: shard after shard, and within a shard one after the other.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.llm import simple8b, tokens
from storelens.llm.bytewords import pieces
from storelens.llm.frames import TEXT, text_column

SEGMENT_BYTES = 2 << 20  # text that goes into one segment, at least one document

SEGMENTS = T.StructType([
    T.StructField("shard", T.IntegerType()),
    T.StructField("segment", T.IntegerType()),
    T.StructField("first", T.LongType()),  # ids of the shard before this segment
    T.StructField("n_ids", T.LongType()),
    T.StructField("null_ids", T.IntegerType()),  # leading documents without a doc_id
    T.StructField("payload", T.BinaryType()),
])
READ = T.StructType([
    T.StructField("shard", T.IntegerType()),
    T.StructField("doc_id", T.LongType()),
    T.StructField("start_in_shard", T.LongType()),
    T.StructField("n_tokens", T.LongType()),
    T.StructField("ids", T.BinaryType()),
])


def write_token_files(
    docs: DataFrame,
    path: str,
    *,
    text: str = "text",
    doc_id: str = "doc_id",
    tokenizer: str | None = None,
    end_id: int = tokens.END_ID,
) -> None:
    """Writes every document's ids below `path`, in ascending `doc_id`.

    A null id comes first; equal ids follow their texts' hashes, and equal rows are all written. A
    null or empty text has the end id alone. The row number in the range key lets an id that many
    rows share spread over shards.
    """
    tokenizer = tokenizer or tokens.default_path()
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_column(docs, text).alias(TEXT))
    keys = ["doc_id", "_tie", "_row"]
    rows = rows.withColumns({"_tie": F.xxhash64(TEXT), "_row": F.monotonically_increasing_id()})
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", TEXT)

    def run(batches):
        shard, first = TaskContext.get().partitionId(), 0
        parts = (p for batch in batches for p in pieces(batch, TEXT, SEGMENT_BYTES))
        for number, (part, texts) in enumerate(parts):
            packed = tokens.encode(texts, tokenizer, end_id)
            ids = np.frombuffer(b"".join(packed), "<u4")
            doc_ids = part.column("doc_id")
            payload = simple8b.pack_segment(
                doc_ids.fill_null(0).to_numpy(), np.array([len(p) // 4 for p in packed]), ids
            )
            row = {
                "shard": [shard], "segment": [number], "first": [first], "n_ids": [len(ids)],
                "null_ids": [doc_ids.null_count], "payload": [payload],
            }
            first += len(ids)
            yield pa.RecordBatch.from_pydict(row, SEGMENTS_ARROW)

    ordered.mapInArrow(run, SEGMENTS).write.parquet(path)


SEGMENTS_ARROW = pa.schema([
    ("shard", pa.int32()), ("segment", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()),
    ("null_ids", pa.int32()), ("payload", pa.binary()),
])


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens, ids (packed)."""
    files = spark.read.schema(SEGMENTS).parquet(path)
    # one row per shard, that is per writing task
    totals = {r["shard"]: r["n"] for r in files.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect()}
    shards = sorted(totals)
    before = dict(zip(shards, itertools.accumulate([0, *(totals[s] for s in shards)])))

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                doc_ids, lengths, ids = simple8b.unpack_segment(row["payload"])
                packed = ids.astype("<u4").tobytes()
                ends = np.cumsum(lengths)
                starts = ends - lengths
                made = {
                    "shard": [row["shard"]] * len(lengths),
                    "doc_id": [None] * row["null_ids"] + doc_ids[row["null_ids"] :].tolist(),
                    "start_in_shard": starts + row["first"] + before[row["shard"]],
                    "n_tokens": lengths,
                    "ids": [packed[4 * s : 4 * e] for s, e in zip(starts.tolist(), ends.tolist())],
                }
                yield pa.RecordBatch.from_pydict(made, READ_ARROW)

    rows = files.select("shard", "first", "null_ids", "payload").mapInArrow(run, READ)
    return rows.select("doc_id", F.col("start_in_shard").alias("start"), "n_tokens", "ids")


READ_ARROW = pa.schema([
    ("shard", pa.int32()), ("doc_id", pa.int64()), ("start_in_shard", pa.int64()),
    ("n_tokens", pa.int64()), ("ids", pa.binary()),
])


def digest(read: DataFrame) -> DataFrame:
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
