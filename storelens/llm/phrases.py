"""Prefix-free parsing of texts: phrases around content-defined triggers.

A rolling hash over strings of `TRIGGER` bytes is taken at every byte. The trigger of a string of
`LENGTH` bytes is the place of the smallest hash in it, the first of equals; it depends on the
string alone, so equal strings have equal triggers at equal distances, wherever they stand. A
phrase is the stretch of text covered by consecutive strings with one trigger.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from storelens.llm.bytewords import BYTE_VALUES, U64, mix, powers

LENGTH = 400
TRIGGER = 160
STRETCH = 1 << 18  # bytes hashed at a time


@dataclass
class Phrases:
    """Phrases in text order; numbers are bytes."""

    text: np.ndarray  # number of the text
    first: np.ndarray  # start of the first string
    count: np.ndarray  # strings, one after another
    at: np.ndarray  # trigger, from the phrase's start
    trigger: np.ndarray  # hash of the trigger
    content: np.ndarray  # hash of the phrase, count + length - 1 bytes


def parse(texts: list[bytes], length: int = LENGTH, trigger: int = TRIGGER) -> Phrases:
    parts, at = [], 0
    while at < len(texts):
        if len(texts[at]) > STRETCH:
            parts += _long(texts[at], at, length, trigger)
            at += 1
            continue
        upto, size = at, 0
        while upto < len(texts) and size + len(texts[upto]) <= STRETCH:
            size += len(texts[upto])
            upto += 1
        lengths = np.array([len(t) for t in texts[at:upto]], np.int64)
        parts.append(_parse(b"".join(texts[at:upto]), lengths, at, length, trigger))
        at = upto
    columns = zip(*([p.text, p.first, p.count, p.at, p.trigger, p.content] for p in parts))
    return Phrases(*(np.concatenate(c) for c in columns)) if parts else _none()


def _none() -> Phrases:
    empty = np.zeros(0, np.int64)
    return Phrases(empty, empty, empty, empty, empty.astype(U64), empty.astype(U64))


def _long(text: bytes, number: int, length: int, trigger: int) -> list[Phrases]:
    """A long text in stretches that share length - 1 bytes; a phrase may be cut where they meet.

    The cut makes two phrases of one; strings and triggers stay as they are.
    """
    parts = []
    for at in range(0, len(text) - length + 1, STRETCH):
        piece = text[at : at + STRETCH + length - 1]
        made = _parse(piece, np.array([len(piece)]), number, length, trigger)
        made.first += at
        parts.append(made)
    return parts


def _parse(joined: bytes, lengths: np.ndarray, number: int, length: int, trigger: int) -> Phrases:
    data = np.frombuffer(joined, np.uint8)
    if len(data) < length:
        return _none()
    forward, backward = powers(len(data))
    sums = np.empty(len(data) + 1, U64)
    sums[0] = 0
    np.cumsum(BYTE_VALUES[data] * forward[: len(data)], out=sums[1:])
    grams = mix((sums[trigger:] - sums[:-trigger]) * backward[: len(data) - trigger + 1])
    bits = U64(max(1, int(len(data)).bit_length()))
    smallest = (grams >> bits << bits) | np.arange(len(grams), dtype=U64)
    width, have = length - trigger + 1, 1
    while have < width:  # minimum over `have` places, doubled
        step = min(have, width - have)
        smallest = np.minimum(smallest[: len(smallest) - step], smallest[step:])
        have += step
    place = (smallest & U64((1 << int(bits)) - 1)).astype(np.int64)
    # strings that lie inside one text
    stops = np.cumsum(lengths)
    starts = stops - lengths
    strings = np.maximum(0, lengths - length + 1)
    owner = np.repeat(np.arange(len(lengths)), strings)
    begin = np.arange(len(owner)) - np.repeat(np.cumsum(strings) - strings, strings) + starts[owner]
    if not len(begin):
        return _none()
    at = place[begin]
    new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (owner[1:] != owner[:-1]))))
    count = np.diff(np.append(new, len(begin)))
    first = begin[new]
    covered = count + length - 1
    content = mix((sums[first + covered] - sums[first]) * backward[first] + covered.astype(U64))
    return Phrases(owner[new] + number, first - starts[owner[new]], count, at[new] - first, grams[at[new]], content)


def _order(contexts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of the contexts, and the common prefix of each with the one before it."""
    order = sorted(range(len(contexts)), key=contexts.__getitem__)
    common = np.zeros(len(contexts), np.int64)
    for k in range(1, len(order)):
        a, b = contexts[order[k - 1]], contexts[order[k]]
        both = min(len(a), len(b))
        if a[:both] == b[:both]:
            common[k] = both
            continue
        differ = np.frombuffer(a, np.uint8, both) != np.frombuffer(b, np.uint8, both)
        common[k] = int(differ.argmax())
    return np.array(order), common


def _classes(contexts: list[bytes], lengths: np.ndarray) -> np.ndarray:
    """Per context and length: the same number for contexts with equal beginnings of that length."""
    order, common = _order(contexts)
    out = np.empty((len(contexts), len(lengths)), np.int64)
    out[order] = np.cumsum(common[:, None] < lengths[None, :], axis=0)
    return out


def repeated(phrases: list[bytes], at: np.ndarray, low: np.ndarray, high: np.ndarray, length: int = LENGTH):
    """Whether strings of distinct phrases with one trigger occur in two of them.

    A string of phrase r lies with o bytes before the trigger at[r], low[r] <= o <= high[r]. Two
    strings are equal if o is, and so are o bytes to the left and length - o to the right. The
    contexts on either side are ordered once; a string's place in both orders is its class.
    Returns the o of the first column and a matrix phrases x o.
    """
    span = np.arange(int(low.min()), int(high.max()) + 1)
    left = _classes([p[:a][::-1] for p, a in zip(phrases, at.tolist())], span)
    right = _classes([p[a:] for p, a in zip(phrases, at.tolist())], length - span)
    both = left * (len(phrases) + 1) + right
    outside = (span[None, :] < low[:, None]) | (span[None, :] > high[:, None])
    both[outside] = -1 - np.broadcast_to(np.arange(len(phrases))[:, None], both.shape)[outside]
    order = np.argsort(both, axis=0, kind="stable")
    ranked = np.take_along_axis(both, order, axis=0)
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(both.shape, bool)
    twice[1:] |= same
    twice[:-1] |= same
    out = np.empty(both.shape, bool)
    np.put_along_axis(out, order, twice, axis=0)
    return int(span[0]), out
