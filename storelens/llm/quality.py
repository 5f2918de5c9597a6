"""Quality rules: a short-circuit cascade ordered by what a sample says of each rule.

All DataFrame functions. A rule rejects a text by a measure; measures build on one another (words,
their hashes, hashes of 8-word windows). On a sample each rule's rejections are counted and its
time is taken, and the rules run in the order of rejections per second. A text that a rule has
rejected skips the measures of the rules behind it. The order changes the time, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.llm.frames import numbered, stored, text_column

SAMPLE_ROWS = 1000  # expected size of the sample that orders the rules
WINDOW = 8
MIN_WORDS = 20
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _words(c: Callable[[str], Column]) -> Column:
    bare = F.trim(c("_text"), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[ \t-\r]+"))


def _lines(c) -> Column:
    return F.filter(F.split(c("_text"), "\n"), lambda line: line.rlike(r"[^ \t-\r]"))


def _without(text: Column, letters: str) -> Column:
    return F.length(F.translate(text, letters, ""))


def _from(a: Column, skip: int) -> Column:
    return F.slice(a, 1 + skip, F.greatest(F.size(a) - skip, F.lit(0)))


def _upto(a: Column, skip: int) -> Column:
    return F.slice(a, 1, F.greatest(F.size(a) - skip, F.lit(0)))


def _pairs(a: Column, gap: int) -> Column:
    """Hashes of a[i] and a[i + gap]."""
    return F.zip_with(_upto(a, gap), _from(a, gap), lambda x, y: F.xxhash64(x, y))


def _places(c) -> Column:
    """The windows sorted, if one occurs twice; else nothing."""
    numbered = F.transform(c("_grams"), lambda gram, at: F.struct(gram.alias("gram"), at.alias("at")))
    unique = F.size(F.array_distinct(c("_grams"))) == F.size(c("_grams"))
    return F.when(unique, F.slice(numbered, 1, 0)).otherwise(F.array_sort(numbered))


def _repeated(c) -> Column:
    """Sorted starts of the windows that occur twice or more."""
    none = F.array().cast("array<int>")
    same = F.zip_with(
        _upto(c("_places"), 1), _from(c("_places"), 1),
        lambda x, y: F.when(x["gram"] == y["gram"], F.array(x["at"], y["at"])).otherwise(none),
    )
    return F.when(F.size(c("_places")) == 0, none).otherwise(F.array_sort(F.array_distinct(F.flatten(same))))


def _covered(c) -> Column:
    """Words inside windows with these starts."""
    starts = c("_repeats")
    following = F.concat(_from(starts, 1), F.array(F.element_at(starts, -1) + WINDOW))
    steps = F.zip_with(starts, following, lambda a, b: F.least(b - a, F.lit(WINDOW)))
    total = F.aggregate(steps, F.lit(0).cast("bigint"), lambda n, s: n + s)
    return F.when(F.size(starts) == 0, F.lit(0).cast("bigint")).otherwise(total)


def _count(a: Column) -> Column:
    return F.size(a).cast("bigint")


# Measures by name, each after those that it is made from. Windows are compared by their hashes:
# within one text two different windows share a 64-bit hash once in 10^10 texts of 25,000 words.
MEASURES: dict[str, Callable[[Callable[[str], Column]], Column]] = {
    "_words": _words,
    "n_words": lambda c: _count(c("_words")),
    "word_chars": lambda c: _without(c("_text"), BLANKS).cast("bigint"),
    "n_symbols": lambda c: (F.length(c("_text")) - _without(c("_text"), SYMBOLS)).cast("bigint"),
    "_capitals": lambda c: F.length(c("_text")) - _without(c("_text"), CAPITALS),
    "_lines": _lines,
    "n_dup_lines": lambda c: _count(c("_lines")) - _count(F.array_distinct(c("_lines"))),
    "_hashes": lambda c: F.transform(c("_words"), lambda w: F.xxhash64(w)),
    "_stutters": lambda c: F.size(
        F.filter(F.zip_with(_upto(c("_hashes"), 1), _from(c("_hashes"), 1), lambda x, y: x == y), lambda same: same)
    ),
    "_two": lambda c: _pairs(c("_hashes"), 1),
    "_four": lambda c: _pairs(c("_two"), 2),
    "_grams": lambda c: _pairs(c("_four"), 4),
    "_places": _places,
    "_repeats": _repeated,
    "n_repeat_words": _covered,
}


@dataclass(frozen=True)
class Rule:
    name: str
    needs: tuple[str, ...]  # measures, with those below them, in the order of MEASURES
    rejects: Callable[[Callable[[str], Column]], Column]


RULES = (
    Rule("short", ("_words", "n_words"), lambda c: c("n_words") < MIN_WORDS),
    Rule(
        "repeated windows",
        ("_words", "n_words", "_hashes", "_two", "_four", "_grams", "_places", "_repeats", "n_repeat_words"),
        lambda c: F.lit(100) * c("n_repeat_words") > F.lit(30) * c("n_words"),
    ),
    Rule("symbols", ("_words", "n_words", "n_symbols"), lambda c: F.lit(5) * c("n_symbols") > c("n_words")),
    Rule("capitals", ("word_chars", "_capitals"), lambda c: F.lit(10) * c("_capitals") > F.lit(4) * c("word_chars")),
    Rule("stutter", ("_words", "n_words", "_hashes", "_stutters"), lambda c: F.lit(10) * c("_stutters") > F.lit(4) * c("n_words")),
    Rule("long words", ("_words", "n_words", "word_chars"), lambda c: c("word_chars") > F.lit(20) * c("n_words")),
    Rule("duplicate lines", ("_lines", "n_dup_lines"), lambda c: F.lit(10) * c("n_dup_lines") > F.lit(6) * _count(c("_lines"))),
)
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
PREFIX = "__q"


def _column(name: str) -> Column:
    return F.col(f"{PREFIX}{name}")


def with_measures(df: DataFrame, names: Sequence[str], only: Column | None = None) -> DataFrame:
    """Adds measures that `df` lacks, one projection each; null where `only` is false."""
    for name in (m for m in MEASURES if m in names):
        if f"{PREFIX}{name}" not in df.columns:
            value = MEASURES[name](_column)
            df = df.withColumn(f"{PREFIX}{name}", value if only is None else F.when(only, value))
    return df


def _prepared(docs: DataFrame, text: str) -> DataFrame:
    return docs.withColumn(f"{PREFIX}_text", F.coalesce(text_column(docs, text), F.lit("")))


def order_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> list[Rule]:
    """The rules by rejections per second on a sample; cheaper first among equals."""
    share = min(1.0, SAMPLE_ROWS / max(1, docs.count()))
    sample = docs.select(text_column(docs, text).alias("text"))
    sample = stored(sample if share == 1.0 else sample.sample(share, seed=17), "sample")
    rank = {}
    for rule in rules:
        measured = with_measures(_prepared(sample, "text"), rule.needs)
        probe = measured.agg(F.count_if(rule.rejects(_column)).alias("n"))
        seconds = []
        for _ in range(2):  # the first run also compiles
            began = time.perf_counter()
            rejected = probe.first()["n"]
            seconds.append(time.perf_counter() - began)
        rank[rule.name] = (-rejected / min(seconds), min(seconds))
    return sorted(rules, key=lambda r: rank[r.name])


def cascade(docs: DataFrame, order: Sequence[Rule], text: str = "text", report: Sequence[str] = ()) -> DataFrame:
    """Adds `kept`, false where a rule rejects the text, and the measures in `report` for all rows.

    Each rule's measures are made only for texts that the rules before it left. A null text counts
    as empty: no words, so it is short. Ties, repeated rows and extra columns are carried row by
    row; columns with the name of an added one give way to it.
    """
    carried = [c for c in docs.columns if c not in (*report, "kept")]
    df = with_measures(_prepared(docs.select(*(F.col(f"`{c}`") for c in carried)), text), _below(report))
    left = F.lit(True)
    for number, rule in enumerate(order):
        df = with_measures(df, rule.needs, left)
        flag = f"{PREFIX}_left{number}"
        df = df.withColumn(flag, F.when(left, ~rule.rejects(_column)).otherwise(False))
        left = F.col(flag)
    return df.select(*(F.col(f"`{c}`") for c in carried), *(_column(m).alias(m) for m in report), left.alias("kept"))


def _below(names: Sequence[str]) -> list[str]:
    """The measures and those that they are made from, no others."""
    needed: set[str] = set()

    def need(name: str) -> Column:
        if name in MEASURES and name not in needed:
            needed.add(name)
            MEASURES[name](need)
        return _column(name)

    for name in names:
        need(name)
    return [m for m in MEASURES if m in needed]


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that no rule rejects, with the columns of `docs`."""
    rows, names = numbered(docs)
    judged = cascade(rows, order_rules(rows, text=names[text]), names[text])
    # a column that differs by partition keeps Spark from moving the filter below the measures, which
    # would write them out again inside it
    judged = judged.withColumn(f"{PREFIX}_part", F.spark_partition_id())
    return judged.filter(F.col("kept") & (_column("_part") >= 0)).select(*rows.columns).toDF(*docs.columns)


def digest(docs: DataFrame) -> DataFrame:
    judged = cascade(docs.select("doc_id", "text"), order_rules(docs), report=BASE)
    base_failed = (F.col("n_words") < MIN_WORDS) | (F.lit(100) * F.col("n_repeat_words") > F.lit(30) * F.col("n_words"))
    return judged.select("doc_id", *BASE, base_failed.alias("base_failed"), "kept")
