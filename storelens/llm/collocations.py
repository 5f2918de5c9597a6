"""Phrase collocation mining by best-first growth with bounds.

A phrase's score is the least of 1000 a n / (l r) over its cuts. Since a phrase is no more frequent
than what follows its first word, nothing that begins with a word can score above 1000 n / f(word):
the count of a prefix bounds all phrases grown from it. So first words are expanded from the rarest
on, a batch at a time. Once a language has `top` surviving phrases, only first words remain whose
bound reaches the last one's score; when they are expanded too, nothing outside can enter or tie.

Words are 64-bit hashes, phrases the hashes of their words in a row. Texts are kept as such rows,
broken where a piece ends or a word is too rare to be part of a phrase. What a pass over them looks
for is a Spark table; tasks get a bit table of fixed size for it, and counts are joined with the
table itself, so that the bits' false hits go.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storelens.llm.bytewords import U64, Words, mix, ngram_hashes, pieces, range_hashes, word_hashes, words_of
from storelens.llm.frames import TEXT, numbered, stored, text_column

LEAST = 100
LONGEST = 5
TOP = 2000
NO_LANG = "und"
FIRST_BATCH = 8  # the first batch: words up to so many times the least count
NEXT_BATCH = 64  # while a language has too few phrases: words up to so many times the last batch's
FILTER_BITS = 24
WORD_BYTES = 8
PIECE = 1 << 20
ROW_WORDS = 1 << 13
SCORE = 1000
BREAKS = b".,;:!?\n\x0b\x0c\r"
SPACES = b" \t"
LETTERS = np.ones(256, bool)
LETTERS[list(BREAKS + SPACES)] = False
BREAKING = np.zeros(256, bool)
BREAKING[list(BREAKS)] = True


def _salt(lang: str) -> np.uint64:
    return U64(xxhash.xxh64_intdigest(lang.encode()))


def _hashes(words: Words) -> np.ndarray:
    out = word_hashes(words)
    out[out == 0] = 1  # zero is a break
    return out


def _by_lang(part: pa.RecordBatch, texts: list[bytes]):
    """Each language's texts of a part."""
    langs = part.column("lang").to_pylist()
    for lang in dict.fromkeys(langs):
        yield lang, [t for t, own in zip(texts, langs) if own == lang]


def _grams(rows: np.ndarray) -> pa.Array:
    """Rows of hashes as binary values."""
    width = WORD_BYTES * rows.shape[1]
    flat = pa.py_buffer(np.ascontiguousarray(rows).tobytes())
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(rows), [None, flat]).cast(pa.binary())


def word_counts(texts: DataFrame) -> DataFrame:
    """Columns lang, word, a; the number of all words stands under the empty word."""

    def run(batches):
        for batch in batches:
            for part, rows in pieces(batch, TEXT, PIECE):
                for lang, own in _by_lang(part, rows):
                    words = words_of(own, LETTERS, lower=True)
                    _, at, count = np.unique(_hashes(words), return_index=True, return_counts=True)
                    found = [words.data[a:b].tobytes() for a, b in zip(words.start[at].tolist(), words.end[at].tolist())]
                    spelled = pa.array([b"", *found], pa.binary()).cast(pa.string())
                    numbers = pa.array(np.concatenate([[len(words.start)], count]), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(spelled), pa.string()), spelled, numbers], names=["lang", "word", "a"])

    return texts.mapInArrow(run, "lang string, word string, a bigint").groupBy("lang", "word").agg(F.sum("a").alias("a"))


def _with_grams(words: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            spelled = [w.encode() for w in batch.column("word").to_pylist()]
            length = np.array([len(w) for w in spelled], np.int64)
            end = np.cumsum(length)
            hashes = range_hashes(np.frombuffer(b"".join(spelled), np.uint8), end - length, end)
            hashes[hashes == 0] = 1
            yield batch.append_column("gram", _grams(hashes[:, None]))

    return words.mapInArrow(run, "lang string, word string, a bigint, gram binary")


class Bits:
    """A bit per hash value of the phrases in a table, of `FILTER_BITS` places whatever its size."""

    def __init__(self, grams: DataFrame):
        def run(batches):
            for batch in batches:
                place = np.zeros(0, U64)
                for lang, own in _by_lang(batch, batch.column("gram").to_pylist()):
                    for size in {len(g) for g in own}:
                        rows = np.frombuffer(b"".join(g for g in own if len(g) == size), U64)
                        # the hashes of a phrase are a window of their own
                        whole = ngram_hashes(rows, size // WORD_BYTES)[:: size // WORD_BYTES]
                        place = np.concatenate([place, _places(whole, lang)])
                words, bits = _or_by_word(place)
                yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(bits.view(np.int64))], names=["word", "bits"])

        rows = grams.select("lang", "gram").mapInArrow(run, "word bigint, bits bigint")
        # 2^18 rows at most
        table = rows.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
        bits = np.zeros(1 << (FILTER_BITS - 6), U64)
        bits[table.column("word").to_numpy()] = table.column("bits").to_numpy().view(U64)
        self.empty = len(table) == 0
        self.shared = grams.sparkSession.sparkContext.broadcast(bits)


def _places(hashes: np.ndarray, lang: str) -> np.ndarray:
    return mix(hashes ^ _salt(lang)) >> U64(64 - FILTER_BITS)


def _or_by_word(place: np.ndarray):
    place = np.unique(place)
    words, first = np.unique((place >> U64(6)).astype(np.int64), return_index=True)
    bits = np.bitwise_or.reduceat(U64(1) << (place & U64(63)), first) if len(first) else np.zeros(0, U64)
    return words, bits


def _hit(bits: np.ndarray, place: np.ndarray) -> np.ndarray:
    return (bits[(place >> U64(6)).astype(np.int64)] >> (place & U64(63))) & U64(1) != 0


def _stretches(hashes: np.ndarray) -> list[np.ndarray]:
    """Cut at breaks into rows that stay small in the readers' batches."""
    breaks = np.flatnonzero(hashes == 0)
    if not len(breaks):
        return [hashes]
    first = np.unique(breaks // ROW_WORDS, return_index=True)[1]
    return np.split(hashes, breaks[first][1:])


def encoded(texts: DataFrame, words: DataFrame) -> DataFrame:
    """The texts' frequent words as hashes, zero where two do not stand together in a piece."""
    shared = Bits(words).shared

    def run(batches):
        for batch in batches:
            for part, rows in pieces(batch, TEXT, PIECE):
                for lang, own in _by_lang(part, rows):
                    found = words_of(own, LETTERS, lower=True)
                    if not len(found.start):
                        continue
                    hashes = _hashes(found)
                    frequent = _hit(shared.value, _places(ngram_hashes(hashes, 1), lang))
                    broken = np.cumsum(BREAKING[found.data])[found.start] + found.row
                    joined = frequent[1:] & frequent[:-1] & (broken[1:] == broken[:-1])
                    behind, ahead = np.append(False, joined), np.append(joined, False)
                    kept = behind | ahead
                    size = kept * (1 + ~behind)
                    out = np.zeros(int(size.sum()), U64)
                    out[(np.cumsum(size) - 1)[kept]] = hashes[kept]
                    made = [v.tobytes() for v in _stretches(out)]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(made), pa.string()), pa.array(made, pa.binary())], names=["lang", "words"])

    return texts.mapInArrow(run, "lang string, words binary")


def _joined(batch: pa.RecordBatch):
    """Some rows of a language at a time, as one array."""
    langs, words = batch.column("lang"), batch.column("words")
    sizes = pc.fill_null(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    at = 0
    while at < len(sizes):
        upto = max(at + 1, int(np.searchsorted(np.cumsum(sizes[at:]), PIECE)) + at)
        part = langs.slice(at, upto - at).to_pylist()
        data = words.slice(at, upto - at).to_pylist()
        for lang in dict.fromkeys(part):
            # a row begins with a break, so rows do not run into one another
            yield lang, np.frombuffer(b"".join(d for d, own in zip(data, part) if own == lang), U64)
        at = upto


WHOLE, RIGHT, LEFT = "whole", "right", "left"


def _cut(first: int | Column, length: int | Column) -> Column:
    return F.substring("gram", first, length)


def counted(rows: DataFrame, grams: DataFrame, lengths: list[int], side: str, least: int) -> DataFrame:
    """Occurrences (lang, gram, a) of the phrases in `grams`, or of those one word longer to a side,
    of which there are `least` or more."""
    bits = Bits(grams)
    if bits.empty:
        return grams.select("lang", "gram", F.lit(0).cast("bigint").alias("a")).limit(0)
    shared, more = bits.shared, int(side != WHOLE)

    def run(batches):
        for batch in batches:
            for lang, hashes in _joined(batch):
                breaks = np.concatenate([[0], np.cumsum(hashes == 0)])
                for length in lengths:
                    width = length + more
                    if len(hashes) < width:
                        continue
                    unbroken = breaks[width:] == breaks[:-width]
                    known = _hit(shared.value, _places(ngram_hashes(hashes, length), lang))
                    known = known[1:] if side == LEFT else known[: len(unbroken)]
                    spot = np.flatnonzero(unbroken & known)
                    _, at, count = np.unique(ngram_hashes(hashes, width)[spot], return_index=True, return_counts=True)
                    windows = np.lib.stride_tricks.sliding_window_view(hashes, width)[spot[at]]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), _grams(windows), pa.array(count.astype(np.int64))], names=["lang", "gram", "a"])

    found = rows.mapInArrow(run, "lang string, gram binary, a bigint").groupBy("lang", "gram").agg(F.sum("a").alias("a"))
    found = found.where(F.col("a") >= least)
    size = F.octet_length("gram")
    part = {WHOLE: F.col("gram"), RIGHT: _cut(1, size - WORD_BYTES), LEFT: _cut(1 + WORD_BYTES, size)}[side]
    wanted = grams.select("lang", F.col("gram").alias("_part")).distinct()
    return found.withColumn("_part", part).join(wanted, ["lang", "_part"], "left_semi").select("lang", "gram", "a")


def _score(a: str, n: str, left: str, right: str) -> Column:
    """floor(1000 a n / (l r)) in decimals of 38 digits; the quotient is below 10 n."""
    wide = {c: f"cast({c} as decimal(18, 0))" for c in (a, n, left, right)}
    return F.expr(f"{SCORE} * ({wide[a]} * {wide[n]}) div ({wide[left]} * {wide[right]})")


def _scored(grams: DataFrame, known: DataFrame, totals: DataFrame) -> DataFrame:
    """The phrases (lang, gram, a) with the lowest-scoring cut: l, r, n, score."""
    size = F.octet_length("gram")
    cuts = grams.withColumn("k", F.explode(F.sequence(F.lit(1), (size / WORD_BYTES).cast("int") - 1)))
    cuts = cuts.withColumns({"_l": _cut(1, F.col("k") * WORD_BYTES), "_r": _cut(F.col("k") * WORD_BYTES + 1, size)})
    for part, name in (("_l", "l"), ("_r", "r")):
        cuts = cuts.join(known.select("lang", F.col("gram").alias(part), F.col("a").alias(name)), ["lang", part])
    cuts = cuts.join(totals, "lang").withColumn("score", _score("a", "n", "l", "r"))
    least = F.min(F.struct("score", "k", "l", "r", "n")).alias("cut")
    return cuts.groupBy("lang", "gram", "a").agg(least).select("lang", "gram", "a", "cut.l", "cut.r", "cut.n", "cut.score")


def _ranked(pool: DataFrame, top: int) -> DataFrame:
    """The first `top` of each language by score and count, with all that tie with the last."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    return pool.withColumn("_rank", F.rank().over(order)).where(F.col("_rank") <= top).drop("_rank")


def mine(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP, longest: int = LONGEST
) -> DataFrame:
    """Each language's best phrases: lang, rank, phrase, a, l, r, n, score.

    Null texts count as empty, null languages as `und`. Repeated rows count as often as they stand
    there. Equal scores and counts are ranked by the phrase's bytes. A language without a phrase of
    `least` occurrences has no row. Equal 64-bit hashes of words count as equal words.
    """
    rows, names = numbered(docs)
    texts = rows.select(F.coalesce(text_column(rows, names[lang]), F.lit(NO_LANG)).alias("lang"), text_column(rows, names[text]).alias(TEXT))
    counts = stored(word_counts(texts).where((F.col("a") >= least) | (F.col("word") == "")), "word-counts")
    totals = counts.where("word = ''").select("lang", F.col("a").alias("n"))
    words = stored(_with_grams(counts.where("word <> ''")), "words")
    runs = stored(encoded(texts, words), "word-runs")
    single = words.select("lang", "gram", "a")

    known, best = [single], None
    # per language: words up to `high` are expanded; what scores below `score` is out of the question
    state = totals.withColumns({"low": F.lit(0).cast("bigint"), "high": F.lit(FIRST_BATCH * least).cast("bigint"), "score": F.lit(0).cast("bigint")})
    while True:
        batch = single.join(state, "lang").where("a > low and a <= high")
        grown, frontier = [], batch
        for length in range(1, longest):
            frontier = stored(counted(runs, frontier, [length], RIGHT, least), "grown")
            grown.append(frontier)
        new = reduce(DataFrame.union, grown)
        known.append(new)
        # a rest begins with any word, so its count may be unknown yet
        rests = new.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(longest - 2))))
        rests = rests.select("lang", _cut(F.col("k") * WORD_BYTES + 1, F.octet_length("gram")).alias("gram"))
        rests = rests.where(F.octet_length("gram") >= 2 * WORD_BYTES).distinct()
        rests = stored(rests.join(reduce(DataFrame.union, known), ["lang", "gram"], "left_anti"), "rests")
        known.append(stored(counted(runs, rests, list(range(2, longest)), WHOLE, least), "rest-counts"))
        scored = _scored(new, reduce(DataFrame.union, known), totals)
        scored = scored.join(state.select("lang", F.col("score").alias("_floor")), "lang").where("score >= _floor").drop("_floor")
        longer = new.select("lang", _cut(1, F.octet_length("gram") - WORD_BYTES).alias("gram"), "a").distinct()
        scored = stored(scored.join(longer, ["lang", "gram", "a"], "left_anti"), "scored")
        short = scored.where(F.octet_length("gram") < longest * WORD_BYTES)
        left = counted(runs, short, list(range(2, longest)), LEFT, least)
        left = left.select("lang", _cut(1 + WORD_BYTES, F.octet_length("gram")).alias("gram"), "a").distinct()
        surviving = scored.join(left, ["lang", "gram", "a"], "left_anti")
        best = stored(_ranked(surviving if best is None else best.unionByName(surviving), top), "best")

        last = best.groupBy("lang").agg(F.when(F.count("*") >= top, F.min("score")).otherwise(0).alias("found"))
        state = state.drop("score").join(last, "lang", "left").withColumn("score", F.coalesce("found", F.lit(0)))
        # the words whose bound reaches the score, rarest first
        reached = F.expr(f"case when score > 0 then ({SCORE} * cast(n as decimal(20, 0))) div score else greatest(high, 1) * {NEXT_BATCH} end")
        state = stored(state.select("lang", "n", F.col("high").alias("low"), reached.cast("bigint").alias("high"), "score"), "state")
        if single.join(state, "lang").where("a > low and (score = 0 or a <= high)").isEmpty():
            return _spelled(best, words, top)


def _spelled(best: DataFrame, words: DataFrame, top: int) -> DataFrame:
    places = best.withColumn("at", F.explode(F.sequence(F.lit(0), (F.octet_length("gram") / WORD_BYTES).cast("int") - 1)))
    places = places.select("lang", F.col("gram").alias("whole"), "at", _cut(F.col("at") * WORD_BYTES + 1, F.lit(WORD_BYTES)).alias("gram"))
    # five words at most in a group
    own = places.join(words.select("lang", "gram", "word"), ["lang", "gram"]).groupBy("lang", F.col("whole").alias("gram"))
    phrases = own.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.join(phrases, ["lang", "gram"]).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
