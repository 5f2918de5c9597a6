"""Toxicity: a linear softmax over averaged subword vectors, trained jointly with them in numpy.

A misspelt word shares most character n-grams with the word it is meant to be, and so its vector.
Texts become bags of subword buckets where they lie, whatever their length; training takes the bags
of a bounded sample of labelled rows on the driver, and scoring runs where the texts are.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.frames import field, map_texts, stored
from storelens.llm.samples import held_out, learnable, some_of
from storelens.llm.subwords import BITS, Bags, Model, Scorer, bags, sigmoid, train

SAMPLE_ROWS = 6000  # labelled rows trained on at most, a third of them toxic where there are so many
SAMPLE_BUCKETS = 1 << 25  # buckets in the bags of all of them at most, 8 bytes each
FETCHED_BUCKETS = 1 << 20  # buckets that come to the driver at a time, and one bag more
STEPS = 1500
THRESHOLD = 0.3


def fit(
    docs: DataFrame, labels: DataFrame, *, text: str = "text", doc_id: str = "doc_id", label: str = "toxic",
    rows: int = SAMPLE_ROWS, steps: int = STEPS,
) -> Model:
    """A model of the labels outside the held-out fold.

    The sample holds more of the rarer class than the table does; the bias is set back by the
    ratio over all rows. It is `rows` rows at most, and those at its front, in the order of their
    ids' hashes, whose bags fit SAMPLE_BUCKETS; a bag has 131,072 buckets at most, however long its
    text. Without both labels the model is the share of toxic rows, a half of one row added.
    """
    known = learnable(labels, label, doc_id)
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    toxic, clean = counts.get(1, 0), counts.get(0, 0)
    prior = Model(np.zeros(1 << BITS, np.float32), math.log((toxic + 0.5) / (clean + 0.5)))
    take = min(toxic, max(rows // 3, rows - clean))
    # at most `rows` rows
    chosen = some_of(known.where("label = 1"), take, 1).union(some_of(known.where("label = 0"), rows - take, 2))
    texts = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("t"))
    sample = texts.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
    held, values = _fetched(stored(_bags(sample), "toxicity-bags"))
    if not 0 < values.sum() < len(values):
        return prior
    model = train(held, values, steps=steps)
    odds = values.sum() / (len(values) - values.sum())
    return model.shifted(math.log(toxic / clean) - math.log(odds))


def _bags(sample: DataFrame) -> DataFrame:
    """doc_id, label, and the buckets of a text's subwords with their weights."""

    def made(texts: list[bytes]) -> dict:
        bag = bags(texts)
        ends = bag.first.astype(np.int32)
        return {"bucket": pa.ListArray.from_arrays(ends, bag.bucket), "weight": pa.ListArray.from_arrays(ends, bag.weight)}

    return map_texts(sample, "t", ["doc_id", "label"], [field("bucket", "array<int>"), field("weight", "array<float>")], made)


def _fetched(made: DataFrame) -> tuple[Bags, np.ndarray]:
    """The bags at the front that fit SAMPLE_BUCKETS, and their labels."""
    made = made.withColumn("at", F.xxhash64("doc_id"))
    order = made.select("at", "label", F.size("bucket").alias("size")).orderBy("at", "doc_id").toArrow()
    at, label, size = (order.column(c).to_numpy().astype(np.int64) for c in ("at", "label", "size"))
    stops = np.cumsum(size)
    first = np.searchsorted(at, at)  # rows of one hash stay together
    fitting = np.flatnonzero(stops > SAMPLE_BUCKETS)
    count = int(first[fitting[0]]) if len(fitting) else len(at)
    stops, first = stops[:count], first[:count]
    part = (stops // FETCHED_BUCKETS)[first]
    bounds = np.concatenate(([0], stops))
    bucket, weight = np.zeros(bounds[-1], np.int32), np.zeros(bounds[-1], np.float32)
    for k in np.unique(part):
        low, high = np.searchsorted(part, k), np.searchsorted(part, k, "right")
        rows = made.where(F.col("at").between(int(at[low]), int(at[high - 1]))).orderBy("at", "doc_id")
        table = rows.select("bucket", "weight").toArrow()
        for column, into in (("bucket", bucket), ("weight", weight)):
            into[bounds[low] : bounds[high]] = table.column(column).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return Bags(bounds, bucket, weight), label[:count].astype(np.float64)


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """The columns `keep` with `score`, from 0 to 1; a null text or one without words scores 0."""
    from storelens.llm.bytewords import ALNUM_WORDS, words_of

    state: dict[str, Scorer] = {}

    def run(texts: list[bytes]) -> dict:
        scorer = state.get("scorer") or state.setdefault("scorer", Scorer(model))
        worded = np.diff(words_of(texts, ALNUM_WORDS, lower=True).first) > 0
        return {"score": np.where(worded, sigmoid(scorer(texts)), 0.0)}

    return map_texts(docs, text, keep, [field("score", "double")], run)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs, fit(docs, labels), ["doc_id"])
    predicted = F.when(F.col("score") >= THRESHOLD, 1).otherwise(0)
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted.alias("predicted"))
