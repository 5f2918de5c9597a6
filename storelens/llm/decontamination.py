"""Benchmark decontamination: multi-pattern search for the benchmarks' word windows in documents.

The search is Wu and Manber's over words. A shift table over blocks of two words says how far a
window may jump; most blocks of ordinary text occur in no benchmark window, so about one block in
twelve words is looked at. Where the shift is 0, the bucket of windows that end with that block is
tried: first word, then all words, then their bytes.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.llm.bytewords import ALNUM_WORDS, BASE, U64, Words, mix, word_hashes, words_of
from storelens.llm.frames import TEXT, field, map_texts, numbered, stored, text_column

WINDOW = 13
BLOCK_BYTES = 4 << 20  # benchmark text searched for in one pass over the documents
LANE = 256  # window ends that one lane of the search walks over
HITS = "array<struct<first:bigint,last:bigint>>"


@dataclass
class Patterns:
    """Distinct windows of one length with their tables."""

    length: int
    hashes: np.ndarray  # windows x words
    words: list[bytes]  # the windows' words joined by a space, in the same order
    items: list[list[str]]
    shift: np.ndarray
    bucket: np.ndarray  # where the windows begin that end with a block, by its table place

    @property
    def block(self) -> int:
        return min(2, self.length)


def _places(ends: np.ndarray, before: np.ndarray, bits: int) -> np.ndarray:
    """Table places of the blocks of two words (or of one word, where `before` is 0)."""
    return (mix(ends + before * U64(BASE)) >> U64(64 - bits)).astype(np.int64)


def build_patterns(items: list[tuple[str, bytes]], window: int) -> list[Patterns]:
    by_length: dict[int, dict[bytes, tuple[np.ndarray, set[str]]]] = defaultdict(dict)
    for item, text in items:
        words = words_of([text], ALNUM_WORDS, lower=True)
        hashes = word_hashes(words)
        length = min(window, len(hashes))
        if not length:
            continue
        spelled = [words.data[s:e].tobytes() for s, e in zip(words.start, words.end)]
        for at in range(len(hashes) - length + 1):
            key = b" ".join(spelled[at : at + length])
            known = by_length[length].setdefault(key, (hashes[at : at + length], set()))
            known[1].add(item)
    return [_tables(length, found) for length, found in sorted(by_length.items())]


def _tables(length: int, found: dict[bytes, tuple[np.ndarray, set[str]]]) -> Patterns:
    keys = list(found)
    hashes = np.stack([found[k][0] for k in keys])
    block = min(2, length)
    bits = int(min(20, max(12, np.ceil(np.log2(len(keys))) + 3)))
    shift = np.full(1 << bits, length - block + 1, np.int32)
    last = None
    for end in range(block - 1, length):
        before = hashes[:, end - 1] if block == 2 else np.zeros(len(keys), U64)
        last = _places(hashes[:, end], before, bits)
        np.minimum.at(shift, last, length - 1 - end)
    order = np.argsort(last, kind="stable")
    bucket = np.searchsorted(last[order], np.arange((1 << bits) + 1)).astype(np.int32)
    keys = [keys[i] for i in order]
    return Patterns(length, hashes[order], keys, [sorted(found[k][1]) for k in keys], shift, bucket)


def search(words: Words, hashes: np.ndarray, patterns: Patterns) -> tuple[np.ndarray, np.ndarray]:
    """First words and window numbers of all occurrences."""
    m, bits = patterns.length, int(np.log2(len(patterns.shift)))
    low, high = words.first[:-1] + m - 1, words.first[1:]  # window ends of each text
    lanes = np.maximum(0, -(-(high - low) // LANE))
    lane = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    at = np.repeat(low, lanes) + lane * LANE
    stop = np.minimum(at + LANE, np.repeat(high, lanes))
    starts, windows = [], []
    while len(at):
        before = hashes[at - 1] if patterns.block == 2 else np.zeros(len(at), U64)
        place = _places(hashes[at], before, bits)
        jump = patterns.shift[place]
        tried = np.flatnonzero(jump == 0)
        if len(tried):
            found = _confirm(words, hashes, patterns, at[tried] - m + 1, place[tried])
            starts.append(found[0])
            windows.append(found[1])
        at = at + np.maximum(jump, 1)
        going = at < stop
        at, stop = at[going], stop[going]
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *starts]), np.concatenate([none, *windows])


def _confirm(words, hashes, patterns: Patterns, start: np.ndarray, place: np.ndarray):
    low, high = patterns.bucket[place], patterns.bucket[place + 1]
    hit_start, hit_window = [], []
    while len(start):
        here = low < high
        start, low, high = start[here], low[here], high[here]
        same = np.flatnonzero(hashes[start] == patterns.hashes[low, 0])
        at = start[same, None] + np.arange(patterns.length)
        same = same[(hashes[at] == patterns.hashes[low[same]]).all(axis=1)]
        for i in same:
            s = int(start[i])
            span = range(s, s + patterns.length)
            spelled = b" ".join(words.data[words.start[k] : words.end[k]].tobytes() for k in span)
            if spelled == patterns.words[low[i]]:
                hit_start.append(s)
                hit_window.append(int(low[i]))
        low = low + 1
    return np.array(hit_start, np.int64), np.array(hit_window, np.int64)


def scan(texts: list[bytes], tables: list[Patterns]) -> dict[str, list]:
    words = words_of(texts, ALNUM_WORDS, lower=True)
    hashes = word_hashes(words)
    spans: list[list[dict]] = [[] for _ in texts]
    items: list[set[str]] = [set() for _ in texts]
    cover = np.zeros(len(hashes) + 1, np.int64)
    for patterns in tables:
        start, window = search(words, hashes, patterns)
        row = np.searchsorted(words.first, start, side="right") - 1
        for r, w in zip(row.tolist(), window.tolist()):
            items[r].update(patterns.items[w])
        np.add.at(cover, start, 1)
        np.add.at(cover, start + patterns.length, -1)
    inside = np.cumsum(cover[:-1]) > 0
    opens = np.zeros(len(inside) + 1, bool)  # words that begin a text: no run crosses them
    opens[words.first] = True
    begin = np.flatnonzero(inside & (~np.roll(inside, 1) | opens[:-1]))
    until = np.flatnonzero(inside & (~np.roll(inside, -1) | opens[1:]))
    row = np.searchsorted(words.first, begin, side="right") - 1
    for r, b, u in zip(row.tolist(), begin.tolist(), until.tolist()):
        first = int(words.first[r])
        spans[r].append({"first": b - first, "last": u - first})
    return {"n_words": np.diff(words.first), "hits": spans, "items": [sorted(i) for i in items]}


def blocks(benchmark: DataFrame, text: str, item: str, limit: int) -> Iterator[list[tuple[str, bytes]]]:
    """The benchmark in parts of about `limit` bytes, so that one pass broadcasts a bounded table."""
    part, size = [], 0
    ids = F.coalesce(F.col(item).cast("string"), F.lit(""))
    for row in benchmark.select(ids.alias("i"), text_column(benchmark, text).alias("t")).toLocalIterator():
        raw = (row["t"] or "").encode()
        if part and size + len(raw) > limit:
            yield part
            part, size = [], 0
        part.append((row["i"], raw))
        size += len(raw)
    if part:
        yield part


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: list[str],
    *,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The columns `keep` of every document with `n_words`, `hits` and `items`.

    `hits` are the runs of words inside any occurrence of a benchmark window, as first and last
    word from 0; `items` the sorted ids, as strings, of the items with an occurring window. A null
    or empty text has no words and no hits; a null or empty item has no windows and a null item id
    counts as the empty string. Repeated rows and ids are looked at one by one; an empty benchmark
    leaves every document clean. Benchmarks beyond `block_bytes` take one pass per block.
    """
    fields = [field("n_words", "bigint"), field("hits", HITS), field("items", "array<string>")]
    parts = blocks(benchmark, item_text, item, block_bytes)
    part = next(parts, [])
    out = _pass(docs, text, [*keep], fields, part, further := next(parts, None), window)
    while further is not None:
        # written before the next block's tables are made, so that no stage holds those of two
        before = stored(out, "block-hits").withColumnsRenamed({"hits": "_hits", "items": "_items"})
        carried = [*keep, "_hits", "_items"]
        out = _pass(before, TEXT, carried, fields, further, further := next(parts, None), window)
        out = out.withColumns({
            "hits": merge_runs(F.concat("hits", "_hits")),
            "items": F.array_sort(F.array_union("items", "_items")),
        }).drop("_hits", "_items")
    return out.select(*keep, "n_words", "hits", "items")


def _pass(docs: DataFrame, text: str, keep: list[str], fields, part, further, window: int) -> DataFrame:
    """One pass with a block of the benchmark; the text goes on if a further block follows."""
    tables = build_patterns(part, window)
    if further is not None and text != TEXT:
        docs = docs.withColumn(TEXT, F.col(text))
    carried = keep if further is None else [*keep, TEXT]
    return map_texts(docs, text, carried, fields, lambda texts: scan(texts, tables))


def merge_runs(runs: Column) -> Column:
    """Union of word runs from several passes, sorted; runs that overlap or touch become one."""
    empty = F.array().cast(HITS)

    def step(done: Column, run: Column) -> Column:
        last = F.element_at(done, -1)
        joins = (F.size(done) > 0) & (run["first"] <= last["last"] + 1)
        longer = F.struct(last["first"].alias("first"), F.greatest(last["last"], run["last"]).alias("last"))
        return F.when(
            joins, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))
        ).otherwise(F.concat(done, F.array(run)))

    return F.aggregate(F.array_sort(runs), empty, step)


def hit_words(hits: Column) -> Column:
    return F.aggregate(hits, F.lit(0).cast("bigint"), lambda n, r: n + r["last"] - r["first"] + 1)


def contaminated(n_words: Column, n_hit: Column) -> Column:
    """A twentieth of the words at least lie inside benchmark windows."""
    return (n_hit > 0) & (F.lit(20) * n_hit >= n_words)


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns: counts, and a checksum of the items."""
    n_hit = hit_words(F.col("hits"))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated(F.col("n_words"), n_hit).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """The documents that are not contaminated, with the columns of `docs`."""
    rows, names = numbered(docs)
    found = find_contamination(rows, benchmark, rows.columns, text=names[text], **options)
    clean = ~contaminated(F.col("n_words"), hit_words(F.col("hits")))
    return found.where(clean).select(*rows.columns).toDF(*docs.columns)
