"""Best-fit packing: documents' token ids into as few sequences of a fixed length as possible.

Minimum bin slack over lengths instead of documents. For each bin a subset sum over the lengths
that are left, kept as the bits of one integer, finds the fullest combination with the longest
piece in it; that combination is taken as often as the counts allow. So planning depends on the
number of distinct lengths, at most the sequence length, and never on the number of documents.
Where a piece goes follows from its length and its number among the pieces of that length.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.llm import tokens
from storelens.llm.bytewords import pieces
from storelens.llm.frames import TEXT, stored, text_column

SEQUENCE = 4096

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("piece", T.IntegerType()),
    T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("task", T.IntegerType()),
    T.StructField("number", T.LongType()),  # among the task's pieces of this length
    T.StructField("ids", T.BinaryType()),
])
PIECES_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
    ("task", pa.int32()), ("number", pa.int64()), ("ids", pa.binary()),
])


def fullest(counts: dict[int, int], room: int) -> Counter:
    """Lengths, as often as `counts` has them, whose sum is the largest up to `room`."""
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted((n for n in counts if n <= room), reverse=True):
        left, take = min(counts[length], room // length), 1
        while left and not reach >> room & 1:
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= reach << length * take & mask
            left -= take
            take *= 2
        if reach >> room & 1:
            break
    at, chosen = reach.bit_length() - 1, Counter()
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            chosen[length] += take
            at -= length * take
    return chosen


def plan(counts: dict[int, int], size: int) -> list[tuple[Counter, int]]:
    """Combinations of lengths and how many bins get each."""
    left = {n: c for n, c in counts.items() if c}
    bins = []
    while left:
        longest = max(left)
        left[longest] -= 1
        chosen = fullest({n: c for n, c in left.items() if c}, size - longest)
        left[longest] += 1
        chosen[longest] += 1
        times = min(left[n] // c for n, c in chosen.items())
        bins.append((chosen, times))
        for n, c in chosen.items():
            left[n] -= c * times
            if not left[n]:
                del left[n]
    return bins


@dataclass
class Places:
    """Sorted by length and first number: runs of pieces that go into bins in the same way."""

    key: np.ndarray  # length and first number in one integer
    number: np.ndarray  # first piece number of the run
    each: np.ndarray  # pieces of that length in a bin
    bin: np.ndarray  # bin of the run's first pieces
    offset: np.ndarray  # place in the bin of the first of them

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        run = np.searchsorted(self.key, length << 48 | number, side="right") - 1
        nth = number - self.number[run]
        return self.bin[run] + nth // self.each[run], self.offset[run] + nth % self.each[run] * length


def places(bins: list[tuple[Counter, int]]) -> Places:
    rows, used, base = [], Counter(), 0
    for chosen, times in bins:
        offset = 0
        for length, each in sorted(chosen.items(), reverse=True):
            rows.append((length << 48 | used[length], used[length], each, base, offset))
            used[length] += each * times
            offset += each * length
        base += times
    columns = np.array(sorted(rows), np.int64).reshape(-1, 5).T
    return Places(*columns)


def cut(docs: DataFrame, text: str, doc_id: str, size: int, tokenizer: str, end_id: int) -> DataFrame:
    """Pieces of at most `size` ids, numbered by length within each task."""
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_column(docs, text).alias(TEXT))

    def run(batches):
        task, seen = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            for part, texts in pieces(batch, TEXT):
                made = {name: [] for name in PIECES_ARROW.names}
                for owner, ids in zip(part.column("doc_id").to_pylist(), tokens.encode(texts, tokenizer, end_id)):
                    for k, at in enumerate(range(0, len(ids), 4 * size)):
                        piece = ids[at : at + 4 * size]
                        length = len(piece) // 4
                        values = (owner, k, at // 4, length, task, seen[length], piece)
                        for column, value in zip(made.values(), values):
                            column.append(value)
                        seen[length] += 1
                yield pa.RecordBatch.from_pydict(made, PIECES_ARROW)

    return rows.mapInArrow(run, PIECES)


def pieces_of(
    docs: DataFrame,
    *,
    text: str = "text",
    doc_id: str = "doc_id",
    size: int = SEQUENCE,
    tokenizer: str | None = None,
    end_id: int = tokens.END_ID,
) -> DataFrame:
    """The pieces of all documents, written once: doc_id, piece, start, length, ids (packed) and their numbers."""
    return stored(cut(docs, text, doc_id, size, tokenizer or tokens.default_path(), end_id), "pieces")


def placed(cuts: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """The rows of `cuts`, in whatever columns besides length, task and number, with sequence_id and offset."""
    by_task = cuts.groupBy("length", "task").agg(F.max("number").alias("last"))
    # one row per task in a group: the tasks' shares of a length, one behind the other
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    shares = by_task.withColumn("before", F.coalesce(F.sum(F.col("last") + 1).over(earlier), F.lit(0)))
    # at most `size` rows
    counts = {
        r["length"]: r["n"]
        for r in by_task.groupBy("length").agg(F.sum(F.col("last") + 1).alias("n")).collect()
    }
    found = places(plan(counts, size))

    @F.pandas_udf("struct<sequence_id:bigint,offset:bigint>")
    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        bins, offsets = found.find(length.to_numpy(), number.to_numpy())
        return pd.DataFrame({"sequence_id": bins, "offset": offsets})

    numbered = cuts.join(shares.select("length", "task", "before"), ["length", "task"])
    numbered = numbered.withColumn("place", place("length", F.col("before") + F.col("number")))
    return numbered.select("*", "place.sequence_id", "place.offset").drop("task", "number", "before", "place")


def pack(docs: DataFrame, *, size: int = SEQUENCE, **options) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids (packed), sequence_id, offset.

    Only documents of more than `size` ids are cut. A null or empty text is its end id alone; a
    null or repeated doc_id is carried as it is, one document per row; no documents, no pieces.
    """
    packed = placed(pieces_of(docs, size=size, **options), size)
    return packed.select("doc_id", "piece", "start", "length", "ids", "sequence_id", "offset")


def digest(docs: DataFrame, **options) -> DataFrame:
    """As `pack`, with the ids' checksum, taken before any row moves, in place of the ids."""
    cuts = pieces_of(docs, **options).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return placed(cuts).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
