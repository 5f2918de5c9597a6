"""SimHash near-dedup by tiled exact comparison of fingerprints.

A fingerprint bit is the majority of that bit over the XXH64 hashes of all word shingles of a text,
repeats included. Distinct fingerprints lie in tiles by the population counts of their four
quarters. Two fingerprints that differ in r bits have counts that differ by r in sum at most, so a
tile meets only the tiles within the radius, half of them, since the others meet it. Tiles are
compared in numpy by exclusive-or and bit counts, in strips whose counts per byte are held against
one another first. A tile gives out a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.bytewords import SPACE_WORDS, U64, Words, words_of
from storelens.llm.frames import field, map_texts, numbered, stored
from storelens.llm.graphs import components

WORDS = 3
RADIUS = 2
SEED = 42
STRETCH = 1 << 16  # shingles whose bits are counted at a time
TILE = 8192  # fingerprints that are held while others stream past
STRIP = 256
QUARTERS, QUARTER_BITS = 4, 16
# the bits of a byte as the bytes of a word, lowest first: lanes that add up without carry 255 times
LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view("<u8").ravel()
LANE_ROWS = 255


def _shingles(words: Words, n: int):
    """The words one space apart, and per shingle its bytes there; shingles per text."""
    data = words.data.copy()
    data[words.end] = 32
    keep = SPACE_WORDS[words.data]
    keep[words.end] = True
    place = np.cumsum(keep) - keep
    start, end = place[words.start], place[words.end]
    held = np.diff(words.first)
    count = np.where(held == 0, 0, np.maximum(held - n + 1, 1))
    before = np.cumsum(count) - count
    first = np.arange(int(count.sum())) + np.repeat(words.first[:-1] - before, count)
    last = first + np.repeat(np.minimum(held, n), count) - 1
    return data[keep].tobytes(), start[first], end[last], count


def fingerprints(texts: list[bytes], n: int = WORDS) -> np.ndarray:
    """Signed 64-bit fingerprints; zero for a text without words."""
    blob, start, end, count = _shingles(words_of(texts, SPACE_WORDS, lower=True), n)
    digest = xxhash.xxh64_intdigest
    sums = np.zeros((len(texts), 64), np.int64)
    row = np.repeat(np.arange(len(texts)), count)
    for at in range(0, len(start), STRETCH):
        part = slice(at, at + STRETCH)
        hashes = [digest(blob[a:b], SEED) for a, b in zip(start[part].tolist(), end[part].tolist())]
        lanes = LANES[np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)]
        own = row[part]
        # pieces of one text, short enough for a lane
        fresh = np.flatnonzero(np.diff(own, prepend=-1))
        inside = np.arange(len(own)) - np.repeat(fresh, np.diff(np.append(fresh, len(own))))
        piece = np.flatnonzero(inside % LANE_ROWS == 0)
        counted = np.add.reduceat(lanes, piece, axis=0).view(np.uint8).reshape(-1, 64)
        np.add.at(sums, own[piece], counted)
    bits = 2 * sums > count[:, None]
    return np.packbits(bits, axis=1, bitorder="little").view("<i8").ravel()


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Joins the classes of i and j; a class is named after its smallest member, in `label`."""
    while True:
        a, b = label[i], label[j]
        low, high = np.minimum(a, b), np.maximum(a, b)
        if (low == high).all():
            return
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label[:] = label[label]


class Strips:
    """Fingerprints in the order of their counts per byte, with the counts' ranges per strip."""

    def __init__(self, values: np.ndarray):
        counts = np.bitwise_count(values.view(np.uint8).reshape(-1, 8)).astype(np.int16)
        order = np.lexsort(counts.T[::-1])
        self.values, counts = values[order], counts[order]
        at = np.arange(0, len(values), STRIP)
        self.low, self.high = np.minimum.reduceat(counts, at), np.maximum.reduceat(counts, at)

    def near(self, other: Strips, radius: int):
        """Places in both of fingerprints that differ in `radius` bits or fewer."""
        gap = np.maximum(other.low - self.high[:, None], self.low[:, None] - other.high).clip(0).sum(axis=2)
        for a, b in np.argwhere(gap <= radius):
            a, b = a * STRIP, b * STRIP
            # unsigned: of a negative number numpy would count the bits of its absolute value
            apart = np.bitwise_count((self.values[a : a + STRIP, None] ^ other.values[b : b + STRIP]).view(U64))
            i, j = np.nonzero(apart <= radius)
            if len(i):
                yield i + a, j + b


class Tile:
    """One tile's fingerprints, and what is known of their links so far."""

    def __init__(self, values: np.ndarray, radius: int):
        self.radius = radius
        self.strips = Strips(values)
        self.label = np.arange(len(values))
        for i, j in self.strips.near(self.strips, radius):
            _merge(self.label, i, j)

    def meet(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Others past this tile: those that link, each with one fingerprint here."""
        others = Strips(values)
        label = np.concatenate([self.label, np.arange(len(values)) + len(self.label)])
        for i, j in self.strips.near(others, self.radius):
            _merge(label, i, j + len(self.label))
        self.label, theirs = label[: len(self.label)], label[len(self.label) :]
        found = theirs < len(self.label)  # the smallest member is one of this tile's
        return others.values[found], self.strips.values[theirs[found]]

    def own(self) -> tuple[np.ndarray, np.ndarray]:
        values = self.strips.values
        apart = self.label != np.arange(len(values))
        return values[apart], values[self.label[apart]]


def _links(radius: int):
    """Streams sorted tiles: a tile's own fingerprints come before the others it meets."""

    def table(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def run(batches):
        now, held, tile = None, [], None
        for batch in batches:
            cell, number, visits = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("cell", "tile", "visits"))
            values = batch.column("fp").to_numpy()
            change = (np.diff(cell) != 0) | (np.diff(number) != 0) | np.diff(visits)
            cuts = [0, *(np.flatnonzero(change) + 1).tolist(), len(cell)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if (cell[a], number[a]) != now:
                    if held:
                        yield table(*(tile or Tile(np.concatenate(held), radius)).own())
                    now, held, tile = (cell[a], number[a]), [], None
                if not visits[a]:
                    held.append(values[a:b])
                elif held:
                    tile = tile or Tile(np.concatenate(held), radius)
                    yield table(*tile.meet(values[a:b]))
        if held:
            yield table(*(tile or Tile(np.concatenate(held), radius)).own())

    return run


def link_fingerprints(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Columns a and b: links that connect just the distinct fingerprints in `fp` that are connected
    by steps of `radius` bits or fewer."""
    side = QUARTER_BITS + 1
    quarter = [F.bit_count(F.shiftrightunsigned("fp", QUARTER_BITS * k).bitwiseAND(F.lit(2**QUARTER_BITS - 1))) for k in range(QUARTERS)]
    cell = sum((q * side**k for k, q in enumerate(quarter)), F.lit(0))
    placed = distinct.select("fp", cell.cast("int").alias("cell"), *(q.alias(f"q{k}") for k, q in enumerate(quarter)))
    # a row per combination of four counts up to 16: 83,521 at most, whatever the input
    sizes = F.broadcast(placed.groupBy("cell").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles")))
    placed = placed.join(sizes, "cell").withColumn("tile", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))
    steps = [d for d in product(range(-radius, radius + 1), repeat=QUARTERS) if sum(map(abs, d)) <= radius and d >= (0,) * QUARTERS]
    step = F.explode(F.array(*(F.array(*map(F.lit, d)) for d in steps)))
    moved = placed.withColumn("step", step)
    inside = [(F.col(f"q{k}") + F.col("step")[k]).between(0, QUARTER_BITS) for k in range(QUARTERS)]
    target = sum((F.col("step")[k] * side**k for k in range(QUARTERS)), F.col("cell"))
    moved = moved.where(inside[0] & inside[1] & inside[2] & inside[3]).select("fp", "tile", F.col("cell").alias("home"), target.alias("cell"))
    met = moved.join(sizes, "cell").withColumn("to", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    met = met.where((F.col("cell") != F.col("home")) | (F.col("to") > F.col("tile")))
    dealt = placed.select("cell", "tile", F.lit(False).alias("visits"), "fp").union(
        met.select("cell", F.col("to").alias("tile"), F.lit(True).alias("visits"), "fp")
    )
    sorted_tiles = dealt.repartition("cell", "tile").sortWithinPartitions("cell", "tile", "visits")
    return sorted_tiles.mapInArrow(_links(radius), "a bigint, b bigint")


def similar_documents(
    docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", n: int = WORDS, radius: int = RADIUS
) -> DataFrame:
    """One row per document: doc_id, fingerprint (bigint) and component_id.

    Fingerprints with `radius` differing bits or fewer link, and component_id is the smallest doc_id
    that links lead to. A null or empty text and one without words have fingerprint zero, which links
    like any other. A text of fewer words than `n` is one shingle. Repeated rows and ids are rows of
    their own; a null id is a component's id only if all its ids are null. No rows, no rows.
    """
    rows, names = numbered(docs)
    source = rows.select(F.col(names[doc_id]).alias("doc_id"), F.col(names[text]).alias("text"))
    made = map_texts(source, "text", ["doc_id"], [field("fp", "bigint")], lambda t: {"fp": fingerprints(t, n)})
    made = stored(made, "fingerprints")
    distinct = stored(made.groupBy("fp").agg(F.min("doc_id").alias("lowest")), "distinct-fingerprints")
    linked = components(link_fingerprints(distinct, radius)).select(F.col("node").alias("fp"), "root")
    labelled = distinct.join(linked, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = labelled.groupBy("root").agg(F.min("lowest").alias("component_id"))
    of_fp = stored(labelled.join(lowest, "root").select("fp", "component_id"), "fingerprint-components")
    return made.join(of_fp, "fp").select("doc_id", F.col("fp").alias("fingerprint"), "component_id")


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
