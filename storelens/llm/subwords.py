"""Bags of subwords: words as the mean of vectors of themselves and of their character n-grams.

Only a word's score is ever needed, the product of its vector with the output weights, so each
n-gram bucket comes down to one number and scoring looks up one number per word.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from storelens.llm.bytewords import ALNUM_WORDS, BYTE_VALUES, U64, Words, mix, powers, word_hashes, words_of

BITS = 17  # buckets that n-grams and words share
SIZES = (3, 4, 5, 6)  # bytes of an n-gram; a space stands for a word's edges
DIMENSIONS = 8


@dataclass
class Bags:
    """Sparse rows: bucket weights of texts."""

    first: np.ndarray
    bucket: np.ndarray
    weight: np.ndarray

    def __len__(self) -> int:
        return len(self.first) - 1

    def take(self, rows: np.ndarray) -> Bags:
        size = (self.first[1:] - self.first[:-1])[rows]
        stops = np.cumsum(size)
        at = np.repeat(self.first[rows] - stops + size, size) + np.arange(int(stops[-1]) if len(stops) else 0)
        return Bags(np.concatenate(([0], stops)), self.bucket[at], self.weight[at])

    def times(self, values: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0.0], np.cumsum(self.weight * values[self.bucket], dtype=np.float64)))
        return sums[self.first[1:]] - sums[self.first[:-1]]

    def back(self, values: np.ndarray) -> np.ndarray:
        """Sums over rows of the row's value times its weights, by bucket."""
        each = np.repeat(values, np.diff(self.first))
        return np.bincount(self.bucket, self.weight * each, 1 << BITS)


def features(words: Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds and buckets of the features of some words, the whole word first."""
    data = np.concatenate(([32], np.where(ALNUM_WORDS[words.data], words.data, 32), [32])).astype(np.uint8)
    forward, backward = powers(len(data))
    sums = np.concatenate((np.zeros(1, U64), np.cumsum(BYTE_VALUES[data] * forward[: len(data)])))
    low, high = words.start[which], words.end[which] + 2  # with the edges
    parts_owner, parts_hash = [np.arange(len(which))], [_span(sums, backward, low, high)]
    for n in SIZES:
        count = np.maximum(0, high - low - n + 1) * (high - low != n)  # the whole word is there already
        stops = np.cumsum(count)
        at = np.repeat(low - stops + count, count) + np.arange(int(stops[-1]) if len(stops) else 0)
        parts_owner.append(np.repeat(np.arange(len(which)), count))
        parts_hash.append(_span(sums, backward, at, at + n))
    owner = np.concatenate(parts_owner)
    order = np.argsort(owner, kind="stable")
    bucket = (np.concatenate(parts_hash) >> U64(64 - BITS)).astype(np.int64)[order]
    return np.searchsorted(owner[order], np.arange(len(which) + 1)), bucket


def _span(sums: np.ndarray, backward: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return mix((sums[high] - sums[low]) * backward[low] + (high - low).astype(U64))


def bags(texts: list[bytes]) -> Bags:
    """Bucket weights of each text: the mean over its words of the mean over a word's features."""
    first, bucket, weight = [0], [], []
    for text in texts:
        words = words_of([text], ALNUM_WORDS, lower=True)
        _, at, counts = np.unique(word_hashes(words), return_index=True, return_counts=True)
        if len(at):
            bounds, own = features(words, at)
            each = np.repeat(counts / counts.sum() / np.diff(bounds), np.diff(bounds))
            used, place = np.unique(own, return_inverse=True)
            bucket.append(used.astype(np.int32))
            weight.append(np.bincount(place, each).astype(np.float32))
            first.append(first[-1] + len(used))
        else:
            first.append(first[-1])
    none = np.zeros(0, np.int32)
    return Bags(np.array(first), np.concatenate([none, *bucket]), np.concatenate([none.astype(np.float32), *weight]))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    """A bucket's score, and the bias: logit = bias + mean over words of the mean of bucket scores."""

    score: np.ndarray
    bias: float

    def shifted(self, by: float) -> Model:
        return Model(self.score, self.bias + by)


def train(
    rows: Bags, label: np.ndarray, weight: np.ndarray | None = None, *, steps: int = 1500, batch: int = 256,
    rate: float = 0.5, decay: float = 1e-6, seed: int = 7,
) -> Model:
    """Embeddings and the softmax over two classes together, by adaptive gradient steps."""
    random = np.random.default_rng(seed)
    vectors = random.normal(0, 0.1, (1 << BITS, DIMENSIONS)).astype(np.float32)
    out = random.normal(0, 0.1, DIMENSIONS).astype(np.float32)
    bias = 0.0
    weight = np.ones(len(label)) if weight is None else weight
    seen_vectors, seen_out, seen_bias = np.full((1 << BITS, 1), 1e-8, np.float32), 1e-8, 1e-8
    scale = 20.0  # a few words in a long text have to show
    batch = min(batch, -(-len(label) // 4))
    for _ in range(-(-steps * batch // len(label))):  # a number of steps, however many rows there are
        order = random.permutation(len(label))
        for at in range(0, len(order), batch):
            some = order[at : at + batch]
            part = rows.take(some)
            logit = bias + scale * part.times(vectors @ out)
            error = (sigmoid(logit) - label[some]) * weight[some] / len(some)
            pull = scale * part.back(error).astype(np.float32)
            used = np.flatnonzero(pull)
            step_out = vectors[used].T @ pull[used]
            step = pull[used, None] * out[None, :] + decay * vectors[used]
            seen_vectors[used] += (step**2).mean(axis=1, keepdims=True)
            vectors[used] -= rate * 0.1 * step / np.sqrt(seen_vectors[used])
            seen_out += float((step_out**2).mean())
            out -= rate * 0.1 * step_out / np.sqrt(seen_out)
            seen_bias += float(error.sum() ** 2)
            bias -= rate * float(error.sum()) / np.sqrt(seen_bias)
    return Model((scale * (vectors @ out)).astype(np.float32), bias)


class Scorer:
    """Logits of texts; a worker remembers the scores of the words it has met."""

    def __init__(self, model: Model, bits: int = 20):
        self.model, self.bits = model, bits
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(1 << self.bits, U64)
        self.values = np.zeros(1 << self.bits, np.float32)

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        words = words_of(texts, ALNUM_WORDS, lower=True)
        hashes = word_hashes(words)
        hashes[hashes == 0] = 1
        slot = (hashes >> U64(64 - self.bits)).astype(np.int64)
        values = self.values[slot]
        missing = np.flatnonzero(self.keys[slot] != hashes)
        if len(missing):
            new, nth, inverse = np.unique(hashes[missing], return_index=True, return_inverse=True)
            bounds, bucket = features(words, missing[nth])
            made = np.add.reduceat(self.model.score[bucket], bounds[:-1]) / np.diff(bounds)
            values[missing] = made[inverse]
            # words with the same place replace one another
            place = (new >> U64(64 - self.bits)).astype(np.int64)
            self.keys[place] = new
            self.values[place] = made
            wrong = self.keys[place] != new
            self.keys[place[wrong]] = 0
        sums = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
        counts = np.diff(words.first)
        total = sums[words.first[1:]] - sums[words.first[:-1]]
        return self.model.bias + total / np.maximum(counts, 1)
