"""Simple-8b: word-aligned coding of unsigned integers, vectorised over blocks.

A 64-bit word holds a selector in its upper 4 bits and, below, as many values of one width as fit
into 60 bits. Values of more than 60 bits are escaped: the word holds their place in a table.
Blocks of `BLOCK` values are coded on their own and found by their first word.
"""

from __future__ import annotations

import struct

import numpy as np

U64 = np.uint64
BLOCK = 1024
MAGIC = b"TOK8"
HEADER = struct.Struct("<4sIQQQQQ")  # magic, values a block, documents, values, blocks, words, escapes
ESCAPE = 15

# Selector k from 1 on packs COUNTS[k - 1] values of WIDTHS[k - 1] bits.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = 60 // COUNTS


def _runs(small: np.ndarray, count: int) -> np.ndarray:
    """Whether `count` true values begin at a place, for all but the last 59 places."""
    run, have = small, 1
    while have < count:
        step = min(have, count - have)
        run = run[: len(run) - step] & run[step:]
        have += step
    return run[: len(small) - 59]


def _selectors(padded: np.ndarray) -> np.ndarray:
    """For every place, but for the 59 behind the last, the first selector whose values all fit."""
    out = np.full(len(padded) - 59, ESCAPE, np.uint8)
    largest = int(padded.max(initial=0))
    for k in range(len(COUNTS), 0, -1):  # more values a word, if they fit
        count, width = int(COUNTS[k - 1]), int(WIDTHS[k - 1])
        if largest >> width:
            fits = _runs(padded < U64(1 << width), count)
            if not fits.any():
                break
            out[fits] = k
        else:
            out[:] = k
    return out


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, first word of each block, escaped values.

    A block's last word may hold values of the next block too; its reader leaves them out.
    """
    values = np.asarray(values, U64)
    padded = np.concatenate([values, np.zeros(60, U64)])
    chosen = _selectors(padded)
    counts = np.concatenate(([0], COUNTS, [1]))
    following = np.arange(len(chosen)) + counts[chosen]
    starts = np.arange(0, len(values), BLOCK)
    at, stop = starts, np.minimum(starts + BLOCK, len(values))
    steps = [at]
    while len(at):  # all blocks at once, word by word
        at = following[at]
        going = at < stop
        at, stop = at[going], stop[going]
        steps.append(at)
    place = np.sort(np.concatenate(steps))
    selector = chosen[place]
    words = selector.astype(U64) << U64(60)
    escapes = np.zeros(0, U64)
    for k in np.unique(selector):
        mine = np.flatnonzero(selector == k)
        if k == ESCAPE:
            escapes = padded[place[mine]]
            words[mine] |= np.arange(len(mine), dtype=U64)
            continue
        for i in range(int(COUNTS[k - 1])):
            words[mine] |= padded[place[mine] + i] << U64(i * int(WIDTHS[k - 1]))
    return words, np.searchsorted(place, starts).astype(U64), escapes


def decode(words: np.ndarray, first: np.ndarray, escapes: np.ndarray, total: int) -> np.ndarray:
    """The values; any run of whole blocks can be decoded by its words and first words alone."""
    counts = np.concatenate(([0], COUNTS, [1]))
    selector = (words >> U64(60)).astype(np.int64)
    begins = np.cumsum(counts[selector]) - counts[selector]
    first = first.astype(np.int64)
    block = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(words))))
    place = begins - begins[first][block]  # within the block
    out = np.zeros((len(first), BLOCK + 60), U64)
    payload = words & U64((1 << 60) - 1)
    for k in np.unique(selector):
        mine = np.flatnonzero(selector == k)
        if k == ESCAPE:
            out[block[mine], place[mine]] = escapes[payload[mine].astype(np.int64)]
            continue
        count, width = int(COUNTS[k - 1]), int(WIDTHS[k - 1])
        shifts = (np.arange(count) * width).astype(U64)
        got = (payload[mine, None] >> shifts) & U64((1 << width) - 1)
        out[block[mine, None], place[mine, None] + np.arange(count)] = got
    return out[:, :BLOCK].reshape(-1)[:total]


def pack_segment(doc_ids: np.ndarray, lengths: np.ndarray, values: np.ndarray) -> bytes:
    """A segment of the file format: header, ids and lengths of documents, block offsets, escapes, words."""
    words, first, escapes = encode(values)
    head = HEADER.pack(MAGIC, BLOCK, len(lengths), len(values), len(first), len(words), len(escapes))
    parts = (doc_ids.astype("<i8"), lengths.astype("<u8"), first.astype("<u8"), escapes.astype("<u8"), words.astype("<u8"))
    return head + b"".join(p.tobytes() for p in parts)


def unpack_segment(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents' ids, their lengths, and all values."""
    magic, block, n_docs, n_values, n_blocks, n_words, n_escapes = HEADER.unpack_from(raw)
    if magic != MAGIC or block != BLOCK:
        raise ValueError("not a segment of this format")
    at, arrays = HEADER.size, []
    for count, kind in ((n_docs, "<i8"), (n_docs, "<u8"), (n_blocks, "<u8"), (n_escapes, "<u8"), (n_words, "<u8")):
        arrays.append(np.frombuffer(raw, kind, count, at))
        at += 8 * count
    doc_ids, lengths, first, escapes, words = arrays
    return doc_ids, lengths.astype(np.int64), decode(words, first, escapes, n_values)
