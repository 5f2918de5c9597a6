"""Words and hashes of Arrow text columns, computed with numpy on whole record batches.

Texts stay UTF-8 bytes: a piece of a batch becomes one byte array in which a separator follows
each text, so that no word or window crosses from one row into the next.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 18  # small arrays stay in the processor's cache
U64 = np.uint64
BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
INVERSE = pow(BASE, -1, 1 << 64)
BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | U64(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE_WORDS = np.ones(256, bool)  # words are [^\x20\x09-\x0D]+
SPACE_WORDS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
ALNUM_WORDS = np.zeros(256, bool)  # words are [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
ALNUM_WORDS[0x30:0x3A] = ALNUM_WORDS[0x61:0x7B] = ALNUM_WORDS[0x80:] = True


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Parts of a batch with about `limit` bytes of text, one row at least. Null is empty."""
    texts = batch.column(column)
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    first, total = 0, 0
    for row, length in enumerate(lengths):
        if row > first and total + length > limit:
            yield _piece(batch, column, first, row)
            first, total = row, 0
        total += int(length)
    if len(lengths) > first:
        yield _piece(batch, column, first, len(lengths))


def _piece(batch: pa.RecordBatch, column: str, first: int, last: int):
    part = batch.slice(first, last - first)
    return part, [v or b"" for v in part.column(column).cast(pa.binary()).to_pylist()]


@dataclass
class Words:
    data: np.ndarray  # the texts, each with a separator behind it
    start: np.ndarray  # byte where a word begins
    end: np.ndarray  # byte behind it
    first: np.ndarray  # per text, and once more at the end: its first word

    @property
    def row(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words_of(texts: list[bytes], letters: np.ndarray, lower: bool) -> Words:
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    if lower:
        data = LOWER[data]
    inside = letters[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edges = np.concatenate(([0], edges))
    start, end = edges[0::2], edges[1::2]
    bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
    return Words(data, start, end, np.searchsorted(start, bounds))


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i modulo 2^64 for i below count at least."""
    have = _powers.get(0)
    if have is None or len(have[0]) < count:
        size = max(count, PIECE_BYTES + 4096)
        tables = []
        for base in (BASE, INVERSE):
            table = np.full(size, base, U64)
            table[0] = 1
            tables.append(np.multiply.accumulate(table))
        have = _powers[0] = (tables[0], tables[1])
    return have


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    values = values ^ (values >> U64(30))
    values = values * U64(0xBF58476D1CE4E5B9)
    values ^= values >> U64(27)
    values *= U64(0x94D049BB133111EB)
    values ^= values >> U64(31)
    return values


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end] for ascending starts, whatever their number and length."""
    out = np.empty(len(start), U64)
    at = 0
    while at < len(start):
        origin = int(start[at])
        upto = int(np.searchsorted(start, origin + PIECE_BYTES))
        upto = max(upto, at + 1)
        stop = int(end[at:upto].max())
        forward, backward = powers(stop - origin)
        sums = np.empty(stop - origin + 1, U64)
        sums[0] = 0
        np.cumsum(BYTE_VALUES[data[origin:stop]] * forward[: stop - origin], out=sums[1:])
        low, high = start[at:upto] - origin, end[at:upto] - origin
        out[at:upto] = mix((sums[high] - sums[low]) * backward[low] + (high - low).astype(U64))
        at = upto
    return out


def word_hashes(words: Words) -> np.ndarray:
    return range_hashes(words.data, words.start, words.end)


def ngram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every n consecutive values; rows are not told apart here."""
    count = max(0, len(hashes) - n + 1)
    total = np.zeros(count, U64)
    factor = 1
    for k in range(n):
        factor = factor * BASE % (1 << 64)
        total += hashes[k : k + count] * U64(factor)
    return mix(total + U64(n))
