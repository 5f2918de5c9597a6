"""Quality classifier by co-training: what a text is like, and what is known of its page.

Two logistic models see the same rows through separate features: the content view counts bytes,
repeated words and lines; the metadata view knows source, language and stated length. In each round
both views score all unlabelled rows where they lie, and each trains the other with a bounded sample
of the rows that it is sure of, beside the true labels. The samples are drawn anew in every round, so
a row that a view has come to doubt is not kept. In the end both are calibrated on labelled rows that
neither was trained on, and a logistic model of the calibrated views scores all documents.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.llm.bytewords import SPACE_WORDS, words_of, word_hashes
from storelens.llm.frames import field, map_texts, stored, text_column
from storelens.llm.samples import held_out, learnable, some_of
from storelens.llm.subwords import sigmoid

LABELLED_ROWS = 6000  # labelled rows learned from at most
GIVEN_ROWS = 6000  # rows that a view labels for the other one in a round, of all that it is sure of
ROUNDS = 5
SURE = 0.97
THRESHOLD = 0.5
EXTRA = 6
META_BUCKETS = 64


def content(texts: list[bytes]) -> np.ndarray:
    """Rows of 256 byte shares and some measures of repetition, all from whole texts."""
    out = np.zeros((len(texts), 256 + EXTRA))
    words = words_of(texts, SPACE_WORDS, lower=False)
    hashes = word_hashes(words)
    for row, text in enumerate(texts):
        data = np.frombuffer(text, np.uint8)
        if not len(data):
            continue
        out[row, :256] = np.sqrt(np.bincount(data, minlength=256) / len(data))
        own = hashes[words.first[row] : words.first[row + 1]]
        lines = [line for line in text.split(b"\n") if line.strip()]
        if len(own):
            size = (words.end - words.start)[words.first[row] : words.first[row + 1]]
            out[row, 256:260] = (
                len(np.unique(own)) / len(own), (own[1:] == own[:-1]).sum() / len(own),
                min(size.mean(), 30) / 10, min(len(own) / len(lines), 200) / 100,
            )
            out[row, 260] = len(set(lines)) / len(lines)
            out[row, 261] = np.log1p(len(own)) / 10
    return out


def _code(column: Column, salt: str) -> Column:
    return F.pmod(F.xxhash64(F.lit(salt), F.coalesce(column.cast("string"), F.lit(""))), F.lit(META_BUCKETS)).cast("int")


def metadata_codes(docs: DataFrame, columns: tuple[str, ...]) -> list[Column]:
    """A bucket per metadata column; numbers by their size, a column that is missing as null."""
    codes = []
    for name in columns:
        if name not in docs.columns:
            codes.append(F.lit(0).alias(name))
            continue
        column = F.col(f"`{name}`")
        numeric = docs.schema[name].dataType.simpleString() in ("bigint", "int", "double", "float")
        codes.append(_code(F.round(F.log2(F.greatest(column, F.lit(1)))) if numeric else column, name).alias(name))
    return codes


def one_hot(codes: np.ndarray) -> np.ndarray:
    out = np.zeros((len(codes), codes.shape[1] * META_BUCKETS))
    out[np.arange(len(codes))[:, None], codes + np.arange(codes.shape[1]) * META_BUCKETS] = 1
    return out


@dataclass
class Logistic:
    mean: np.ndarray
    spread: np.ndarray
    weight: np.ndarray
    bias: float

    def logit(self, rows: np.ndarray) -> np.ndarray:
        return (rows - self.mean) / self.spread @ self.weight + self.bias


def fit_logistic(rows: np.ndarray, label: np.ndarray, penalty: float = 1.0, steps: int = 25) -> Logistic:
    """Ridge logistic regression by Newton steps on standardised features."""
    mean, spread = rows.mean(axis=0), rows.std(axis=0) + 1e-6
    spread[spread < 1e-5] = np.inf  # a constant feature says nothing
    x = np.column_stack([(rows - mean) / spread, np.ones(len(rows))])
    ridge = np.diag([penalty] * rows.shape[1] + [1e-6])
    weight = np.zeros(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ weight)
        hessian = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + ridge
        step = np.linalg.solve(hessian, x.T @ (p - label) + ridge @ weight)
        weight -= step
        if np.abs(step).max() < 1e-6:
            break
    return Logistic(mean, spread, weight[:-1], float(weight[-1]))


@dataclass
class CoModel:
    views: list[Logistic]
    scales: list[Logistic]  # calibration of each view's logit
    joint: Logistic | None
    prior: float

    def score(self, content_rows: np.ndarray, meta_rows: np.ndarray) -> np.ndarray:
        if self.joint is None:
            return np.full(len(content_rows), self.prior)
        return sigmoid(self.joint.logit(self.calibrated(content_rows, meta_rows)))

    def calibrated(self, content_rows: np.ndarray, meta_rows: np.ndarray) -> np.ndarray:
        logits = [
            scale.logit(np.clip(view.logit(rows), -30, 30)[:, None])
            for view, scale, rows in zip(self.views, self.scales, (content_rows, meta_rows))
        ]
        return np.column_stack(logits)


# of the two models and the round: the feature rows that each view is given, and their labels
Exchange = Callable[[list[Logistic], int], list[tuple[np.ndarray, np.ndarray]]]


def co_train(views: list[np.ndarray], label: np.ndarray, exchange: Exchange, rounds: int = ROUNDS) -> CoModel:
    """`views` holds the two feature tables of the labelled rows."""
    prior = float((label.sum() + 0.5) / (len(label) + 1))
    fitted = np.arange(len(label)) % 4 != 0  # a quarter calibrates
    if any(not 0 < label[part].sum() < len(label[part]) for part in (fitted, ~fitted)):
        return CoModel([], [], None, prior)
    own = [(v[fitted], label[fitted]) for v in views]
    models = [fit_logistic(*rows) for rows in own]
    for k in range(rounds):
        given = exchange(models, k)
        if not any(len(guess) for _, guess in given):
            break
        models = [
            fit_logistic(np.concatenate([rows, more]), np.concatenate([known, guess]))
            for (rows, known), (more, guess) in zip(own, given)
        ]
    scales = [
        fit_logistic(np.clip(m.logit(v[~fitted]), -30, 30)[:, None], label[~fitted]) for m, v in zip(models, views)
    ]
    model = CoModel(models, scales, None, prior)
    joint = fit_logistic(model.calibrated(*(v[~fitted] for v in views)), label[~fitted])
    return CoModel(models, scales, joint, prior)


def sure(model: Logistic, rows: np.ndarray) -> np.ndarray:
    """1 and 0 for rows that a view is sure of, -1 for others."""
    p = sigmoid(model.logit(rows))
    return np.where(p >= SURE, 1, np.where(p <= 1 - SURE, 0, -1))


META = ("source", "lang", "n_chars")


def _with_features(docs: DataFrame, text: str, doc_id: str, meta: tuple[str, ...], more: tuple[str, ...] = ()) -> DataFrame:
    """_id, _key, a bucket per metadata column, `more` and _f, the content features."""
    body = text_column(docs, text)
    identity = F.col(f"`{doc_id}`")
    named = docs.select(
        identity.alias("_id"),
        F.xxhash64(identity, body).alias("_key"),
        *metadata_codes(docs, meta),
        *(F.col(f"`{m}`") for m in more),
        body.alias("_t"),
    )

    def made(texts: list[bytes]) -> dict:
        rows = content(texts).astype(np.float32)
        ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
        return {"_f": pa.ListArray.from_arrays(ends, rows.ravel())}

    return map_texts(named, "_t", ["_id", "_key", *meta, *more], [field("_f", "array<float>")], made)


def _views(table: pa.Table | pa.RecordBatch, meta: tuple[str, ...]) -> list[np.ndarray]:
    rows = table.num_rows
    values = table.column("_f")
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    codes = [table.column(m).to_numpy(zero_copy_only=False) if isinstance(table, pa.RecordBatch) else table.column(m).to_numpy() for m in meta]
    return [
        values.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(rows, 256 + EXTRA),
        one_hot(np.column_stack(codes) if codes else np.zeros((rows, 0), int)),
    ]


def _exchange(pool: DataFrame, meta: tuple[str, ...]) -> Exchange:
    """Both views score every row of `pool`; GIVEN_ROWS of those that a view is sure of go to the other."""

    def exchange(models: list[Logistic], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        def run(batches):
            for batch in batches:
                guesses = [sure(m, rows) for m, rows in zip(models, _views(batch, meta))]
                some = (guesses[0] >= 0) | (guesses[1] >= 0)
                columns = [pa.array(g[some], pa.int32()) for g in guesses]
                keys = batch.column("_key").filter(pa.array(some))
                yield pa.RecordBatch.from_arrays([keys, *columns], names=["_key", "_0", "_1"])

        told = stored(pool.select("_key", *meta, "_f").mapInArrow(run, "_key bigint, _0 int, _1 int"), "sure")
        counts = told.agg(*(F.count_if(F.col(f"_{v}") >= 0) for v in (0, 1))).first()
        # from 0 to 1, another one for each row in each round and view
        draw = lambda v: F.shiftrightunsigned(F.xxhash64(F.lit(2 * k + v), "_key"), 11) / F.lit(float(1 << 53))
        chosen = [
            # somewhat more than the number wanted before the exact cut, so that it sorts few rows
            told.select("_key", F.lit(v).alias("_from"), F.col(f"_{v}").alias("_guess"), draw(v).alias("_draw"))
            .where((F.col("_guess") >= 0) & (F.col("_draw") < (1.2 * GIVEN_ROWS + 100) / max(counts[v], 1)))
            .dropDuplicates(["_key"])
            .orderBy("_draw", "_key")
            .limit(GIVEN_ROWS)
            for v in (0, 1)
        ]
        # two times GIVEN_ROWS rows at most
        picked = pool.join(F.broadcast(chosen[0].union(chosen[1])), "_key").dropDuplicates(["_key", "_from"])
        table = picked.select("_key", "_from", "_guess", *meta, "_f").orderBy("_from", "_key").toArrow()
        source, guess = (table.column(c).to_numpy() for c in ("_from", "_guess"))
        rows = _views(table, meta)
        return [(rows[v][source != v], guess[source != v].astype(float)) for v in (0, 1)]

    return exchange


def fit(
    docs: DataFrame, labels: DataFrame, *, text: str = "text", doc_id: str = "doc_id", label: str = "quality",
    meta: tuple[str, ...] = META,
) -> CoModel:
    """Views of LABELLED_ROWS labels outside the held-out fold, and of all rows without a label."""
    known = some_of(learnable(labels, label, doc_id), LABELLED_ROWS, 3)
    ids = docs.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`"), *(F.col(f"`{m}`") for m in meta if m in docs.columns))
    # `known` is bounded by LABELLED_ROWS
    marked = ids.join(F.broadcast(known.select(F.col("doc_id").alias(doc_id), F.col("label").alias("_label"))), doc_id)
    learned = _with_features(marked.dropDuplicates([doc_id]), text, doc_id, meta, ("_label",)).orderBy("_id").toArrow()
    pool = _with_features(ids, text, doc_id, meta)
    pool = stored(pool.join(labels.select(F.col(f"`{doc_id}`").alias("_id")), "_id", "left_anti"), "unlabelled")
    return co_train(_views(learned, meta), learned.column("_label").to_numpy().astype(float), _exchange(pool, meta))


def score(
    docs: DataFrame, model: CoModel, keep: list[str], *, text: str = "text", meta: tuple[str, ...] = META
) -> DataFrame:
    """The columns `keep` with `score`, the probability of good quality, for every row.

    A null text counts as empty and null metadata as a value of its own; a text without words scores
    0. Without labels of both kinds every text has the share of good rows.
    """
    from pyspark.sql import types as T

    from storelens.llm.bytewords import pieces
    from storelens.llm.frames import TEXT

    carried = [k for k in keep if k != "score"]
    codes = [c.alias(f"_m{k}") for k, c in enumerate(metadata_codes(docs, meta))]
    source = docs.select(*(F.col(f"`{k}`") for k in carried), *codes, text_column(docs, text).alias(TEXT))
    schema = T.StructType([source.schema[k] for k in carried] + [T.StructField("score", T.DoubleType())])

    def run(batches):
        for batch in batches:
            for part, texts in pieces(batch, TEXT):
                codes = np.column_stack([part.column(f"_m{k}").to_numpy() for k in range(len(meta))])
                worded = np.array([bool(t.strip()) for t in texts])
                values = np.where(worded, model.score(content(texts), one_hot(codes)), 0.0)
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in carried), pa.array(values)], names=[*carried, "score"])

    return source.mapInArrow(run, schema)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs, fit(docs, labels), ["doc_id"])
    good = F.col("score") >= THRESHOLD
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", F.when(good, 1).otherwise(0).alias("predicted"), good.alias("kept")
    )
