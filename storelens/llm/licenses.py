"""License scans: words of fixed phrases, and an exact set-similarity join with license templates.

All DataFrame functions. A block is a set of words: those of a line, or the last words of a line with
the first ones of the lines behind it, as many of both as the longest template has, so that a notice
is found however it is wrapped. Lines without words part paragraphs; no block crosses them. A block
meets a template if it contains a given share of the template's words. Template words are ordered by
how many documents hold them, rarest first. A block that meets a template holds one of its first words (prefix
filter), has enough words (length filter), and enough template words are left on both sides
behind the first one shared (positional filter); what remains is counted exactly.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.llm.frames import numbered, text_column

THRESHOLD = 0.9

# The phrases of the base count, and their labels.
PHRASES = (
    (("cc", "by"), "cc-by"),
    (("general", "public", "license"), "gpl"),
    (("all", "rights", "reserved"), "reserved"),
)
# Sentences of license notices and the labels that they give. `gpl-notice` is the header of
# any version.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("boost-1.0", "Distributed under the Boost Software License, Version 1.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    (
        "bsd",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and "
        "the following disclaimer",
    ),
    (
        "bsd",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
        "and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution",
    ),
    (
        "bsd-3-clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission",
    ),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    (
        "cc0",
        "To the extent possible under law, the author has waived all copyright and related or neighboring "
        "rights to this work",
    ),
    (
        "epl-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public "
        "License 2.0",
    ),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    (
        "gpl-notice",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
        "is hereby granted, provided that the above copyright notice and this permission notice appear in all "
        "copies",
    ),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    (
        "mit",
        "The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software",
    ),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    (
        "zlib",
        "This software is provided as-is, without any express or implied warranty. In no event will the "
        "authors be held liable for any damages arising from the use of this software",
    ),
)
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]  # distinct
    length: int  # words, repeated ones too

    def need(self, threshold: float) -> int:
        return max(1, math.ceil(threshold * len(self.words) - 1e-9))


def words_of(text: Column) -> Column:
    """Lower-case words; only A-Z are lowered."""
    return F.filter(F.split(F.translate(text, CAPITALS, SMALL), GAP), lambda w: w != "")


def count_words(text: Column) -> Column:
    ends = [F.when(text.rlike(p), 1).otherwise(0) for p in (f"^{GAP}", f"{GAP}$")]
    only_gaps = ~text.rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
    return F.when(only_gaps, 0).otherwise(F.size(F.split(text, GAP)) - ends[0] - ends[1]).cast("bigint")


def templates(entries=TEMPLATES) -> list[Template]:
    """The templates as word sets, with the words of the plain ASCII rule of the texts."""
    import re

    made = []
    for label, text in entries:
        words = [w for w in re.split(GAP, text.lower()) if w]
        if words:
            made.append(Template(label, tuple(dict.fromkeys(words)), len(words)))
    return made


def _any_of(words) -> str:
    """A pattern that finds a text with one of the words, in any case of A-Z."""
    # alternatives of literal words: they hold ASCII letters and digits only
    return rf"(?i)(?<![0-9a-z\x80-\x{{10FFFF}}])(?:{'|'.join(sorted(words))})(?![0-9a-z\x80-\x{{10FFFF}}])"


def word_order(docs: DataFrame, text: str, wanted: list[Template]) -> dict[str, tuple[int, str]]:
    """Rank keys of the templates' words: the number of documents that hold them, then the word."""
    vocabulary = sorted({w for t in wanted for w in t.words})
    body = text_column(docs, text)
    held = F.array_intersect(words_of(body), F.array(*map(F.lit, vocabulary)))
    # one row per template word at most
    counts = docs.select(F.explode(held).alias("word")).groupBy("word").count().collect()
    known = {r["word"]: r["count"] for r in counts}
    return {w: (known.get(w, 0), w) for w in vocabulary}


def scan_licenses(
    docs: DataFrame,
    *,
    text: str = "text",
    threshold: float = THRESHOLD,
    entries=TEMPLATES,
) -> DataFrame:
    """`docs` with n_words, places (word starts of the base phrases), base_labels, labels, score.

    `labels` holds the base labels and those of the templates that a block meets; `score` is the
    largest share of a template in a block that meets it, 1 where a base phrase stands, else 0.
    Null texts count as empty: no words, no labels. Added columns replace those of their names;
    repeated rows are scanned one by one.
    """
    wanted = templates(entries)
    order = word_order(docs, text, wanted)
    rank = {w: k for k, w in enumerate(sorted(order, key=order.get))}
    sorted_words = [sorted(t.words, key=rank.get) for t in wanted]
    needs = [t.need(threshold) for t in wanted]
    prefix = {(w, k, p) for k, (ws, n) in enumerate(zip(sorted_words, needs)) for p, w in enumerate(ws[: len(ws) - n + 1])}

    added = ("n_words", "places", "base_labels", "labels", "score")
    kept = [c for c in docs.columns if c not in added]
    docs, names = numbered(docs)
    carried = [names[c] for c in kept]
    body = F.coalesce(text_column(docs, names[text]), F.lit(""))
    phrase_words = {words[-1] for words, _ in PHRASES}
    # a word that no document holds finds no block
    first_words = {w for w, _, _ in prefix if order[w][0]} or {w for w, _, _ in prefix}
    longest = max((t.length for t in wanted), default=0)
    rows = docs.select(
        *carried,
        body.alias("_body"),
        F.monotonically_increasing_id().alias("_row"),
    )
    rows = rows.withColumns({
        "n_words": count_words(F.col("_body")),
        "_spelled": F.when(F.col("_body").rlike(_any_of(phrase_words)), words_of(F.col("_body"))),
        "_lines": F.when(F.col("_body").rlike(_any_of(first_words)), F.transform(F.split("_body", "\n"), words_of)),
    })
    rows = rows.withColumn("_blocks", _blocks(F.col("_lines"), first_words, rank, longest))
    rows = rows.withColumn("places", F.coalesce(_phrase_places(F.col("_spelled")), F.array().cast(PLACES)))
    rows = rows.drop("_body", "_spelled", "_lines")
    pairs = _meeting(rows, wanted, sorted_words, needs, prefix)

    base = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    base_score = F.when(F.size("places") > 0, 1.0).otherwise(0.0)
    return pairs.select(
        *(F.col(names[c]).alias(c) for c in kept),
        "n_words",
        "places",
        base.alias("base_labels"),
        F.array_sort(F.array_union(base, F.col("_found"))).alias("labels"),
        F.greatest(base_score, F.coalesce("_share", F.lit(0.0))).alias("score"),
    )


PLACES = "array<struct<at:bigint,label:string>>"


def _phrase_places(words: Column) -> Column:
    return F.concat(*(_places_of(words, phrase, label) for phrase, label in PHRASES))


def _places_of(words: Column, phrase: tuple[str, ...], label: str) -> Column:
    spots = F.sequence(F.lit(0), F.size(words) - len(phrase))
    starts = F.filter(spots, lambda i: _here(words, i, phrase))
    made = F.transform(starts, lambda i: F.struct(i.cast("bigint").alias("at"), F.lit(label).alias("label")))
    return F.when(F.size(words) >= len(phrase), made).otherwise(F.array().cast(PLACES))


def _here(words: Column, at: Column, phrase: tuple[str, ...]) -> Column:
    same = F.get(words, at) == phrase[0]
    for k, word in enumerate(phrase[1:], 1):
        same = same & (F.get(words, at + k) == word)
    return same


def _blocks(lines: Column, first_words: set[str], rank: dict[str, int], longest: int) -> Column:
    """Blocks with a prefix word: their number of distinct words, and ranks of template words, rarest first."""
    by_rank = F.array(*(F.lit(w) for w in sorted(rank, key=rank.get)))
    firsts = F.array(*map(F.lit, sorted(first_words)))

    def across(line: Column, at: Column) -> Column:
        """The last words of a line and the first ones behind it; empty at the end of a paragraph."""
        behind = F.slice(lines, at + 2, longest)
        gap = F.array_position(F.transform(behind, lambda w: F.size(w) == 0), True)
        behind = F.flatten(F.when(gap > 0, F.slice(behind, 1, gap.cast("int") - 1)).otherwise(behind))
        last = F.slice(line, F.greatest(F.size(line) - longest + 1, F.lit(1)), longest)
        joined = F.concat(last, F.slice(behind, 1, longest))
        return F.when((F.size(line) > 0) & (F.size(behind) > 0), joined).otherwise(F.array().cast("array<string>"))

    def block(words: Column) -> Column:
        return F.struct(
            F.size(F.array_distinct(words)).alias("size"),
            # in the order of by_rank: array_intersect keeps the order of its first side
            F.array_intersect(by_rank, words).alias("words"),
        )

    both = F.concat(lines, F.transform(lines, across))
    return F.array_distinct(F.transform(F.filter(both, lambda words: F.arrays_overlap(words, firsts)), block))


def _meeting(rows: DataFrame, wanted, sorted_words, needs, prefix) -> DataFrame:
    """One row per row of `rows`: the labels of the templates that a block meets, and the best share."""
    spark = rows.sparkSession
    # the prefix words of the fixed templates: some dozen rows
    index = spark.createDataFrame(sorted(prefix), "_word string, _template int, _place int")
    facts = spark.createDataFrame(
        [(k, t.label, len(t.words), n, ws) for k, (t, n, ws) in enumerate(zip(wanted, needs, sorted_words))],
        "_template int, _label string, _size int, _need int, _set array<string>",
    )
    index = index.join(facts, "_template")
    own = [c for c in rows.columns if c != "_blocks"]
    blocks = rows.select(*(F.col(f"`{c}`") for c in own), F.explode_outer("_blocks").alias("_block"))
    tokens = blocks.select(
        *(F.col(f"`{c}`") for c in own),
        "_block",
        F.posexplode_outer(F.col("_block.words")).alias("_at", "_word"),
    )
    joined = tokens.join(F.broadcast(index), "_word", "left")
    long_enough = F.col("_block.size") >= F.col("_need")
    behind = F.least(F.col("_size") - F.col("_place"), F.size("_block.words") - F.col("_at"))
    shared = F.size(F.array_intersect("_block.words", "_set"))
    # nothing before the first shared word is shared; a later one may fail here, the first does not
    meets = F.when(long_enough & (behind + F.least("_place", "_at") >= F.col("_need")), shared >= F.col("_need"))
    joined = joined.withColumn("_meets", F.coalesce(meets, F.lit(False)))
    share = F.when(F.col("_meets"), shared / F.col("_size"))
    return joined.groupBy("_row").agg(
        *(F.first(F.col(f"`{c}`")).alias(c) for c in own if c != "_row"),
        F.collect_set(F.when(F.col("_meets"), F.col("_label"))).alias("_found"),
        F.max(share).alias("_share"),
    )


def digest(scanned: DataFrame) -> DataFrame:
    starts = F.transform("places", lambda p: p["at"])
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )
