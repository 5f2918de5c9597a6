"""Suffix-array dedup: removes every byte inside a string of 400 bytes that occurs elsewhere too.

Prefix-free parsing. Texts become phrases around content-defined triggers (`phrases`), so equal
strings lie in phrases with equal triggers at equal distances. The parse is the table of phrase
hashes in text order, the dictionary the distinct phrases.

1. A phrase that occurs twice repeats all its strings. Nothing else is known of it or needed.
2. Of the other distinct phrases only those whose trigger another phrase shares can repeat a
   string. Their bytes are fetched, one copy of each, and the contexts on both sides of the
   trigger are put in suffix order; a string that occurs in two phrases shows in both orders.
   Phrases that occur twice take part, so that strings shared with them are found.
3. The repeated strings go back to all places of their phrase in the parse.

A trigger that very many phrases share is split: by the string's distance from the trigger, and by
the hash of what all strings with such distances contain. Where a part still has very many phrases,
as around a passage that stands in many texts, its strings are hashed one by one, and Spark counts
the phrases that hold each; no task gets such a part whole.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.llm.bytewords import U64, pieces, range_hashes
from storelens.llm.frames import TEXT, field, numbered, stored, text_column
from storelens.llm.phrases import LENGTH, TRIGGER, parse, repeated

HOT_PHRASES = 4000  # distinct phrases of one trigger or part that a task compares; beyond it they are split or hashed
SPLIT = 40  # distances from the trigger that a part of a split trigger covers
PHRASES_A_BUCKET = 2000
ADDED = ("n_bytes", "n_removed", "n_spans", "kept", "kept_text")
PARSE = "ref bigint, first bigint, count int, at int, trigger bigint, content bigint"
PARSE_ARROW = pa.schema([
    ("ref", pa.int64()), ("first", pa.int64()), ("count", pa.int32()), ("at", pa.int32()),
    ("trigger", pa.int64()), ("content", pa.int64()),
])
PHRASES_ARROW = pa.schema([
    ("trigger", pa.int64()), ("phrases", pa.int64()), ("content", pa.int64()), ("at", pa.int32()),
    ("low", pa.int32()), ("high", pa.int32()), ("data", pa.binary()),
])
PARTS = "trigger bigint, part bigint, content bigint, at int, low int, high int, data binary"
RUNS = "trigger bigint, content bigint, begin int, strings int"


def _with_ref(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """Adds what a row is referred to by; rows with equal id and text share it and all their spans."""
    body = text_column(docs, text)
    return docs.withColumn("_ref", F.xxhash64(F.col(f"`{doc_id}`").cast("bigint"), body)).withColumn(TEXT, body)


def parse_table(rows: DataFrame, length: int = LENGTH, trigger: int = TRIGGER) -> DataFrame:
    """The phrases of all texts in columns _ref and TEXT."""

    def run(batches):
        for batch in batches:
            for part, texts in pieces(batch, TEXT, 4 << 20):
                made = parse(texts, length, trigger)
                refs = part.column("_ref").to_numpy()[made.text]
                columns = [refs, made.first, made.count.astype(np.int32), made.at.astype(np.int32), made.trigger.view(np.int64), made.content.view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=PARSE_ARROW)

    return rows.select("_ref", TEXT).mapInArrow(run, PARSE)


def _phrase_bytes(rows: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of one copy of each wanted phrase."""
    asked = wanted.groupBy("ref").agg(
        F.collect_list(F.struct("first", "count", "at", "trigger", "content", "phrases")).alias("wanted")
    )
    source = rows.select(F.col("_ref").alias("ref"), TEXT).join(asked, "ref")
    # rows with equal id and text share a ref: one of them will do

    def run(batches):
        for batch in batches:
            for piece, texts in pieces(batch, TEXT, 4 << 20):
                made: list[list] = [[] for _ in PHRASES_ARROW.names]
                for text, phrases in zip(texts, piece.column("wanted").to_pylist()):
                    for p in phrases:
                        data = text[p["first"] : p["first"] + p["count"] + length - 1]
                        row = (p["trigger"], p["phrases"], p["content"], p["at"], p["at"] - p["count"] + 1, p["at"], data)
                        for column, value in zip(made, row):
                            column.append(value)
                arrays = [pa.array(c, k) for c, k in zip(made, PHRASES_ARROW.types)]
                yield pa.RecordBatch.from_arrays(arrays, schema=PHRASES_ARROW)

    return source.mapInArrow(run, "trigger bigint, phrases bigint, content bigint, at int, low int, high int, data binary")


def _split(phrases: DataFrame, length: int, trigger: int) -> DataFrame:
    """The phrases in as many parts as a hot trigger is split into."""

    def run(batches):
        for batch in batches:
            for piece, texts in pieces(batch, "data"):
                row, parts = [], []
                at, low, high = (piece.column(c).to_pylist() for c in ("at", "low", "high"))
                for k, data in enumerate(texts):
                    phrase = {"at": at[k], "count": high[k] - low[k] + 1, "phrases": math.inf}
                    for part in _parts(data, phrase, length, trigger):
                        row.append(k)
                        parts.append(part)
                row = pa.array(row, pa.int64())
                made = [pa.array([p[k] for p in parts], kind) for k, kind in enumerate((pa.int64(), pa.int32(), pa.int32()))]
                arrays = [piece.column("trigger").take(row), made[0], piece.column("content").take(row), piece.column("at").take(row), *made[1:], piece.column("data").take(row)]
                yield pa.RecordBatch.from_arrays(arrays, names=["trigger", "part", "content", "at", "low", "high", "data"])

    return phrases.select("trigger", "content", "at", "low", "high", "data").mapInArrow(run, PARTS)


def _parts(data: bytes, phrase: dict, length: int = LENGTH, trigger: int = TRIGGER):
    """(part, least, greatest distance of a string's start from the trigger) of a phrase."""
    at, low, high = phrase["at"], phrase["at"] - phrase["count"] + 1, phrase["at"]
    if phrase["phrases"] <= HOT_PHRASES:
        yield 0, low, high
        return
    array = np.frombuffer(data, np.uint8)
    for first in range(low // SPLIT * SPLIT, high + 1, SPLIT):
        least, most = max(low, first), min(high, first + SPLIT - 1)
        # what every string that begins `first` to `first + SPLIT - 1` bytes before the trigger contains
        inside = np.array([at - first]), np.array([at + max(trigger, length - first - SPLIT + 1)])
        shared = range_hashes(array, *inside)[0] ^ U64(first + 1)
        yield int(shared.view(np.int64)), least, most


def _repeated_runs(table: pa.Table, length: int = LENGTH) -> pa.Table:
    """Runs of repeated strings, by their first string's place in the phrase."""
    keys = np.stack([table.column("trigger").to_numpy(), table.column("part").to_numpy()])
    content = table.column("content").to_numpy()
    at, low, high = (table.column(c).to_numpy().astype(np.int64) for c in ("at", "low", "high"))
    data = table.column("data").to_pylist()
    order = np.lexsort((content, keys[1], keys[0]))
    made: dict[str, list] = {"trigger": [], "content": [], "begin": [], "strings": []}
    change = np.flatnonzero((np.diff(keys[:, order], axis=1) != 0).any(axis=0)) + 1
    for group in np.split(order, change):
        # copies of one phrase can come from rows with equal id and text
        group = group[np.concatenate(([True], np.diff(content[group]) != 0))]
        if len(group) < 2:
            continue
        origin, twice = repeated([data[i] for i in group], at[group], low[group], high[group], length)
        for row, i in enumerate(group.tolist()):
            # strings in text order are those of falling distance from the trigger
            hit = np.concatenate(([False], twice[row, ::-1], [False])).astype(np.int8)
            edges = np.flatnonzero(np.diff(hit))
            farthest = origin + twice.shape[1] - 1
            for begin, end in zip(edges[0::2].tolist(), edges[1::2].tolist()):
                made["trigger"].append(int(keys[0, i]))
                made["content"].append(int(content[i]))
                made["begin"].append(int(at[i]) - farthest + begin)
                made["strings"].append(end - begin)
    kinds = [("trigger", pa.int64()), ("content", pa.int64()), ("begin", pa.int32()), ("strings", pa.int32())]
    return pa.table(made, pa.schema(kinds))


def _strings(parts: DataFrame, length: int) -> DataFrame:
    """The hash of every string of the parts, and where in its phrase it begins."""

    def run(batches):
        for batch in batches:
            for piece, texts in pieces(batch, "data"):
                at, low, high = (piece.column(c).to_numpy().astype(np.int64) for c in ("at", "low", "high"))
                count = high - low + 1
                row = np.repeat(np.arange(len(texts)), count)
                begin = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + (at - high)[row]
                sizes = np.array([len(t) for t in texts])
                start = begin + (np.cumsum(sizes) - sizes)[row]
                hashes = range_hashes(np.frombuffer(b"".join(texts), np.uint8), start, start + length)
                made = [piece.column(c).to_numpy()[row] for c in ("trigger", "content")]
                arrays = [pa.array(c) for c in (*made, begin.astype(np.int32), hashes.view(np.int64))]
                yield pa.RecordBatch.from_arrays(arrays, names=["trigger", "content", "begin", "string"])

    return parts.mapInArrow(run, "trigger bigint, content bigint, begin int, string bigint")


def _counted_runs(parts: DataFrame, length: int) -> DataFrame:
    """As `_repeated_runs`, of parts of any number of phrases: by hashes, which Spark groups."""
    strings = _strings(parts, length)
    # the least and greatest phrase are summed up where the strings are made; a phrase holds a string once
    twice = strings.groupBy("trigger", "string").agg(F.min("content").alias("least"), F.max("content").alias("most"))
    twice = twice.where("least < most").select("trigger", "string")
    # a phrase has a few hundred strings at most
    begins = strings.join(twice, ["trigger", "string"]).groupBy("trigger", "content").agg(
        F.array_sort(F.collect_set("begin")).alias("begins")
    )

    def run(batches):
        for batch in batches:
            lists = batch.column("begins")
            begin = lists.flatten().to_numpy().astype(np.int64)
            row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
            new = np.flatnonzero(np.concatenate(([True], (np.diff(begin) != 1) | (np.diff(row) != 0)))[: len(begin)])
            made = [batch.column(c).to_numpy()[row[new]] for c in ("trigger", "content")]
            strings = np.diff(np.append(new, len(begin)))
            arrays = [pa.array(c) for c in (*made, begin[new].astype(np.int32), strings.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, names=["trigger", "content", "begin", "strings"])

    return begins.mapInArrow(run, RUNS)


def repeated_spans(rows: DataFrame, length: int = LENGTH, trigger: int = TRIGGER) -> DataFrame:
    """Per ref: `spans`, the (begin, end) byte ranges of repeated strings; they may overlap."""
    parsed = parse_table(rows, length, trigger)
    distinct = parsed.groupBy("trigger", "content").agg(
        F.count("*").alias("places"),
        F.min(F.struct("ref", "first")).alias("pick"),
        F.first("count").alias("count"),
        F.first("at").alias("at"),
    )
    # unique phrases with unique triggers, most of all, end here
    sharing = distinct.groupBy("trigger").agg(F.count("*").alias("phrases"), F.sum("places").alias("uses"))
    distinct = stored(distinct.join(sharing.where("uses > 1").drop("uses"), "trigger"), "dictionary")
    wanted = distinct.where("phrases > 1").select("pick.*", "count", "at", "trigger", "content", "phrases")
    sizes = wanted.agg(F.count("*").alias("all"), F.count_if(F.col("phrases") > HOT_PHRASES).alias("hot")).first()
    compared = _phrase_bytes(rows, wanted, length)
    if sizes["hot"]:
        compared = stored(compared, "phrases")
    few = compared.where(F.col("phrases") <= HOT_PHRASES).withColumn("part", F.lit(0).cast("bigint"))
    few = few.select("trigger", "part", "content", "at", "low", "high", "data")
    if sizes["hot"]:
        split = _split(compared.where(F.col("phrases") > HOT_PHRASES), length, trigger)
        crowded = split.groupBy("trigger", "part").count().where(F.col("count") > HOT_PHRASES)
        # one key per HOT_PHRASES phrases at most
        crowded = F.broadcast(stored(crowded.drop("count"), "crowded"))
        few = few.union(split.join(crowded, ["trigger", "part"], "left_anti"))
    parts = -(-(length - trigger + 1) // SPLIT)
    buckets = max(8, -(-(sizes["all"] + sizes["hot"] * parts) // PHRASES_A_BUCKET))
    bucket = F.pmod(F.xxhash64("trigger", "part"), F.lit(buckets)).alias("bucket")
    compare = _repeated_runs
    runs = few.groupBy(bucket).applyInArrow(lambda table: compare(table, length), RUNS)
    if sizes["hot"]:
        runs = runs.union(_counted_runs(split.join(crowded, ["trigger", "part"], "left_semi"), length))
    whole = distinct.where("places > 1").select("trigger", "content", F.lit(0).alias("begin"), F.col("count").alias("strings"))
    once = distinct.where("places = 1").select("trigger", "content")
    found = stored(whole.union(runs.join(once, ["trigger", "content"])), "repeated")
    begin = F.col("first") + F.col("begin")
    spans = parsed.join(found, ["trigger", "content"]).select(
        "ref", F.struct(begin.alias("begin"), (begin + F.col("strings") + (length - 1)).alias("end")).alias("span")
    )
    return spans.groupBy("ref").agg(F.collect_set("span").alias("spans"))


def _cut(text: bytes, spans: list[dict] | None) -> tuple[bytes, int]:
    """What is left of a text without the spans, and the number of maximal removed runs."""
    if not spans:
        return text, 0
    kept, at, runs = [], 0, 0
    for begin, end in sorted((s["begin"], s["end"]) for s in spans):
        if begin > at or not runs:
            kept.append(text[at:begin])
            runs += 1
        at = max(at, end)
    return b"".join([*kept, text[at:]]), runs


def remove_repeats(
    docs: DataFrame, keep: list[str], *, text: str = "text", doc_id: str = "doc_id",
    length: int = LENGTH, trigger: int = TRIGGER,
) -> DataFrame:
    """The columns `keep` of every document with n_bytes, n_removed, n_spans and what is kept.

    `kept` are the other bytes, `kept_text` their whole characters where something was removed.
    Texts are UTF-8 bytes, null is empty. Strings are judged on the input; matches never cross
    documents, and overlapping occurrences in one text count. Texts of less than `length` bytes lose
    nothing; a shorter `trigger` means fewer, longer phrases. Repeated rows and ids are documents of their own; no rows, no rows. Columns in `keep`
    with the name of an added one give way to it.
    """
    rows = _with_ref(docs, text, doc_id)
    spans = repeated_spans(rows, length, trigger)
    carried = [c for c in keep if c not in ADDED]
    joined = rows.select("_ref", TEXT, *(F.col(f"`{c}`") for c in carried)).join(
        spans.withColumnRenamed("ref", "_ref"), "_ref", "left"
    )
    fields = [field("n_bytes", "bigint"), field("n_removed", "bigint"), field("n_spans", "bigint"), field("kept", "binary"), field("kept_text", "string")]
    source = joined.select(*(F.col(f"`{c}`") for c in carried), TEXT, "spans")
    return _with_spans(source, carried, fields)


def _with_spans(source: DataFrame, carried: list[str], fields) -> DataFrame:
    from pyspark.sql import types as T

    schema = T.StructType([source.schema[c] for c in carried] + fields)

    def run(batches):
        for batch in batches:
            for part, texts in pieces(batch, TEXT, 4 << 20):
                cuts = [_cut(t, s) for t, s in zip(texts, part.column("spans").to_pylist())]
                sizes = [len(t) for t in texts]
                made = [
                    pa.array(sizes, pa.int64()),
                    pa.array([n - len(k) for n, (k, _) in zip(sizes, cuts)], pa.int64()),
                    pa.array([r for _, r in cuts], pa.int64()),
                    pa.array([k for k, _ in cuts], pa.binary()),
                    pa.array([k.decode("utf-8", "ignore") if r else None for k, r in cuts], pa.string()),
                ]
                arrays = [part.column(c) for c in carried] + made
                yield pa.RecordBatch.from_arrays(arrays, names=[*carried, *(f.name for f in fields)])

    return source.mapInArrow(run, schema)


def digest(removed: DataFrame) -> DataFrame:
    return removed.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def without_repeats(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", n_chars: str = "n_chars", **sizes: int
) -> DataFrame:
    """The documents without repeated bytes, with their columns; `n_chars`, if there, counts anew.

    Bytes of a character that a removed run cuts through are dropped with it.
    """
    rows, names = numbered(docs)
    removed = remove_repeats(rows, rows.columns, text=names[text], doc_id=names[doc_id], **sizes)
    changed = F.col("n_removed") > 0
    clean: Column = F.col("kept_text")
    columns = []
    for name in rows.columns:
        column = F.col(name)
        if name == names[text]:
            column = F.when(changed, clean).otherwise(column)
        elif name == names.get(n_chars):
            column = F.when(changed, F.length(clean).cast(rows.schema[name].dataType)).otherwise(column)
        columns.append(column.alias(name))
    return removed.select(*columns).toDF(*docs.columns)
