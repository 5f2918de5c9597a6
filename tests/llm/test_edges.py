"""Nulls, empty and very long texts, ties, repeated rows, empty tables, and clashing columns."""

import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from storelens.llm import (
    cotraining, decontamination, licenses, main_text, ngram_join, packing, quality, repeats, simple8b,
    token_files, tokens, toxicity,
)
from storelens.llm.graphs import components
from storelens.llm.html_blocks import DROP, MAIN, OTHER, blocks
from storelens.llm.phrases import parse
from storelens.llm.prefix_tree import Links, link_all, link_probes
from storelens.llm.queries import ORACLE_SQL
from storelens.session import scratch_path

WORDS = [f"w{k}" for k in range(400)]
LONG = " ".join(random.Random(5).choices(WORDS, k=60_000))
TEXT = " ".join(random.Random(6).choices(WORDS, k=300))
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ROWS = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \t\n\x0b", "en", "a", 4),
    (4, LONG, "en", None, len(LONG)),
    (5, TEXT, "en", "a", len(TEXT)),
    (5, TEXT, "en", "a", len(TEXT)),  # a repeated row
    (6, TEXT, None, "b", len(TEXT)),
    (None, TEXT, "en", "a", len(TEXT)),
    (7, "one", "en", "a", 3),
    (8, "All rights reserved. Released under the MIT License.", "en", "a", 1),
]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture
def none(docs):
    return docs.limit(0)


@pytest.fixture
def clashing(docs):
    names = [
        "n_words", "kept", "score", "labels", "hits", "items", "component_id", "n_bytes", "ids", "length",
        "task", "number", "key", "_row", "_ref", "_hash", "__text", "place", "spans", "_body",
    ]
    return docs.withColumns({n: F.lit("x") for n in names})


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append(r)
    return out


def test_quality_rules(docs, none, clashing):
    rows = by_id(quality.digest(docs))
    assert [rows[k][0].n_words for k in (1, 2, 3, 4, 7)] == [0, 0, 0, 60_000, 1]
    assert all(rows[k][0].base_failed and not rows[k][0].kept for k in (1, 2, 3, 7))
    assert rows[5][0].kept and rows[5][0] == rows[5][1]
    assert quality.digest(none).count() == 0
    assert sorted(by_id(quality.keep_good(docs)), key=str) == [4, 5, 6, None]
    kept = quality.keep_good(clashing)
    assert kept.columns == clashing.columns and kept.first().kept == "x"
    assert quality.keep_good(none).count() == 0


def test_any_order_of_rules_gives_the_same_verdicts(docs):
    want = sorted(quality.cascade(docs, quality.RULES).collect(), key=str)
    for seed in range(2):
        order = random.Random(seed).sample(quality.RULES, len(quality.RULES))
        assert sorted(quality.cascade(docs, order).collect(), key=str) == want


def test_ngram_join(docs, none, clashing):
    rows = by_id(ngram_join.similar_documents(docs))
    assert {r.component_id for k in (5, 6, None) for r in rows[k]} == {5}
    assert [rows[k][0].n_shingles for k in (1, 2, 3, 7)] == [0, 0, 0, 1]
    assert [rows[k][0].component_id for k in (1, 2, 3, 4, 7)] == [1, 2, 3, 4, 7]
    assert ngram_join.similar_documents(none).count() == 0
    kept = ngram_join.one_of_each(clashing)
    assert kept.columns == clashing.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 5, 7, 8]
    assert ngram_join.one_of_each(none).count() == 0


def test_ngram_join_in_blocks(spark, monkeypatch):
    """A family larger than a task's share: links through blocks and what they leave apart."""
    monkeypatch.setattr(ngram_join, "GROUP_SETS", 20)
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 10)
    r = random.Random(3)
    base = r.choices(WORDS, k=200)
    rows = []
    for k in range(90):
        words = list(base)
        for _ in range(r.randint(0, 9)):
            words[r.randrange(200)] = r.choice(WORDS)
        rows.append((k, " ".join(words)))
    got = by_id(ngram_join.similar_documents(spark.createDataFrame(rows, "doc_id bigint, text string")))
    assert [got[k][0].component_id for k in range(90)] == brute_components(rows)


def brute_components(rows):
    sets = [ngram_join.shingle_sets([t.encode()], 4)[0] for _, t in rows]
    links = Links(len(rows))
    for i in range(len(rows)):
        for j in range(i):
            n = len(np.intersect1d(sets[i], sets[j]))
            if 100 * n >= 85 * (len(sets[i]) + len(sets[j]) - n):
                links.join(i, j)
    return links.roots().tolist()


@pytest.mark.parametrize("group_sets", [6, 4000])
def test_ngram_join_of_families_of_many_sizes(spark, monkeypatch, group_sets):
    """Cut, extended and changed copies around the threshold: links where sizes differ most."""
    monkeypatch.setattr(ngram_join, "GROUP_SETS", group_sets)
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 5)
    r = random.Random(11)
    bases = [r.choices(WORDS, k=n) for n in (8, 30, 60, 150, 150)]
    rows = []
    for k in range(120):
        words = list(r.choice(bases))
        cut = r.randint(0, len(words) // 6)
        words = words[cut:] if r.random() < 0.5 else words[: len(words) - cut]
        words += [f"own{k}x{i}" for i in range(r.randint(0, len(words) // 8))]
        for _ in range(r.randint(0, 2)):
            words[r.randrange(len(words))] = r.choice(WORDS)
        rows.append((k, " ".join(words)))
    got = by_id(ngram_join.similar_documents(spark.createDataFrame(rows, "doc_id bigint, text string")))
    assert [got[k][0].component_id for k in range(120)] == brute_components(rows)


def test_sets_out_of_reach_form_no_groups(spark):
    """A template in which every text has so much of its own that no two can be 85 % alike."""
    ordered = [(k, b"", 100, 10, list(range(6))) for k in range(500)]
    frame = spark.createDataFrame(ordered, "key bigint, set binary, length bigint, alone bigint, prefix array<bigint>")
    assert ngram_join._heads(frame, 85).count() == 0
    # 80 values, all of them shared, can do for 86 with 5 of its own, but not for 100
    near = spark.createDataFrame([(500, b"", 80, 0, [0, 1]), (501, b"", 86, 5, [0, 1])], frame.schema)
    heads = ngram_join._heads(frame.union(near), 85)
    assert {row.key for row in heads.collect()} == {500, 501}


def test_prefix_tree_finds_every_link():
    r = np.random.default_rng(0)
    for _ in range(60):
        bases = [r.choice(60, r.integers(1, 25), replace=False) for _ in range(4)]
        made = set()
        for _ in range(r.integers(2, 30)):
            some = set(bases[r.integers(4)].tolist())
            for _ in range(r.integers(0, 4)):
                some = some ^ {int(r.integers(60))} or some
            made.add(tuple(sorted(some)))
        sets = [np.array(s, np.uint64) for s in made]
        want = Links(len(sets))
        for i in range(len(sets)):
            for j in range(i):
                n = len(np.intersect1d(sets[i], sets[j]))
                if 100 * n >= 85 * (len(sets[i]) + len(sets[j]) - n):
                    want.join(i, j)
        assert (link_all(sets, 85).roots() == want.roots()).all()
        half = len(sets) // 2
        if half:
            probed = link_probes(sets[:half], sets[half:], 85, list(range(len(sets))))
            for part, at in ((sets[:half], 0), (sets[half:], half)):
                own = link_all(part, 85)
                for k in range(len(part)):
                    probed.join(at + k, at + own.find(k))
            assert (probed.roots() == want.roots()).all()


def test_components(spark):
    path = [(k, k + 1) for k in range(40)]
    star = [(1000, 1000 + k) for k in range(1, 50)]
    frame = spark.createDataFrame([*path, *star, (7, 7)], "a bigint, b bigint")
    roots = {r.node: r.root for r in components(frame).collect()}
    assert roots == {**{k: 0 for k in range(41)}, **{1000 + k: 1000 for k in range(50)}}
    assert components(frame.limit(0)).count() == 0


def test_suffix_dedup(docs, none, clashing):
    rows = by_id(repeats.digest(repeats.remove_repeats(docs, ["doc_id"])))
    assert [rows[k][0].n_bytes for k in (1, 2, 3, 7)] == [0, 0, 4, 3]
    assert all(r.n_removed == r.n_bytes > 0 and r.n_spans == 1 for k in (5, 6, None) for r in rows[k])
    assert repeats.digest(repeats.remove_repeats(none, ["doc_id"])).count() == 0
    clean = repeats.without_repeats(clashing)
    assert clean.columns == clashing.columns
    texts = {r.doc_id: (r.text, r.n_chars, r.hits) for r in clean.collect()}
    assert texts[5] == ("", 0, "x") and texts[1] == (None, None, "x") and texts[7] == ("one", 3, "x")


def brute(texts, length):
    from collections import Counter

    seen = Counter(t[k : k + length] for t in texts for k in range(len(t) - length + 1))
    return [[seen[t[k : k + length]] > 1 for k in range(len(t) - length + 1)] for t in texts]


@pytest.mark.parametrize("letters", [b"a", b"ab", b"abcdefgh"])
def test_phrases_of_one_trigger_find_all_repeats(monkeypatch, letters):
    """Triggers split and not, texts longer than a stretch, texts of few letters."""
    import pyarrow as pa

    monkeypatch.setattr("storelens.llm.phrases.STRETCH", 1500)
    r = random.Random(len(letters))
    for hot in (4000, 1):
        monkeypatch.setattr(repeats, "HOT_PHRASES", hot)
        base = bytes(r.choices(letters, k=900))
        texts = [base, base[100:700] + bytes(r.choices(letters, k=500)), bytes(r.choices(letters, k=2600)) + base[:450], b"", b"x" * 399]
        made = parse(texts)
        dictionary = {}
        for text, first, count, at, trigger, content in zip(made.text, made.first, made.count, made.at, made.trigger, made.content):
            dictionary.setdefault((trigger, content), []).append((text, first, count, at))
        sharing = {}
        for trigger, content in dictionary:
            sharing.setdefault(trigger, []).append(content)
        rows = {k: [] for k in ("trigger", "part", "content", "at", "low", "high", "data")}
        for (trigger, content), places in dictionary.items():
            if len(sharing[trigger]) > 1:
                text, first, count, at = places[0]
                data = texts[text][first : first + count + 399]
                phrase = {"at": int(at), "count": int(count), "phrases": len(sharing[trigger])}
                for part, low, high in repeats._parts(data, phrase):
                    for column, value in zip(rows.values(), (trigger.astype(np.int64), part, content.astype(np.int64), at, low, high, data)):
                        column.append(value)
        got = [[False] * max(0, len(t) - 399) for t in texts]
        runs = {k: [(0, places[0][2])] for k, places in dictionary.items() if len(places) > 1}
        if rows["trigger"]:
            for found in repeats._repeated_runs(pa.table(rows)).to_pylist():
                key = (np.int64(found["trigger"]).astype(np.uint64), np.int64(found["content"]).astype(np.uint64))
                runs.setdefault(key, []).append((found["begin"], found["strings"]))
        for key, places in dictionary.items():
            for begin, strings in runs.get(key, ()):
                for text, first, _, _ in places:
                    got[text][first + begin : first + begin + strings] = [True] * int(strings)
        assert got == brute(texts, 400)


@pytest.mark.parametrize(("length", "trigger"), [(400, 160), (250, 64)])
def test_a_passage_in_very_many_texts_is_never_one_group(spark, monkeypatch, length, trigger):
    """Parts that the split leaves hot are counted by hashes; the repeats are the same."""
    monkeypatch.setattr(repeats, "HOT_PHRASES", 20)
    compare = repeats._repeated_runs

    def bounded(table, length):
        seen = {(r["trigger"], r["part"], r["content"]) for r in table.select(["trigger", "part", "content"]).to_pylist()}
        groups = [(trigger, part) for trigger, part, _ in seen]
        assert max(map(groups.count, groups)) <= 20
        return compare(table, length)

    monkeypatch.setattr(repeats, "_repeated_runs", bounded)
    r = random.Random(8)

    def some(size):
        return "".join(r.choices("abcdefgh", k=size))

    passage = some(620)
    texts = [some(r.randint(0, 700)) + passage[r.choice([0, 0, 0, 90]) : r.choice([620, 620, 530])] + some(r.randint(0, 700)) for _ in range(60)]
    texts += [texts[0][:-20] + some(50), texts[1], some(30) + texts[2][50:], some(900)]
    rows = [*enumerate(texts), (0, texts[0])]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = {}
    for (k, text), strings in zip(rows, brute([t for _, t in rows], length)):
        removed = {i for at, hit in enumerate(strings) if hit for i in range(at, at + length)}
        want.setdefault(k, []).append("".join(c for i, c in enumerate(text) if i not in removed))
    got = by_id(repeats.remove_repeats(frame, ["doc_id"], length=length, trigger=trigger))
    assert {k: [bytes(x.kept).decode() for x in v] for k, v in got.items()} == want


def test_decontamination(spark, docs, none, clashing):
    bench = spark.createDataFrame([(1, TEXT), (2, None), (3, ""), (4, "one"), (None, "w1 w2")], "item_id bigint, text string")
    rows = by_id(decontamination.digest(decontamination.find_contamination(docs, bench, ["doc_id"])))
    assert [(rows[k][0].n_words, rows[k][0].n_hit, rows[k][0].contaminated) for k in (1, 2, 3, 7)] == [
        (0, 0, False), (0, 0, False), (0, 0, False), (1, 1, True),
    ]
    assert rows[5][0].n_hit == 300 and rows[5][0] == rows[5][1] and rows[4][0].n_words == 60_000
    assert decontamination.find_contamination(none, bench, ["doc_id"]).count() == 0
    clean = decontamination.find_contamination(docs, bench.limit(0), ["doc_id"])
    assert {r.n_words for r in clean.collect()} >= {0, 300} and not any(r.hits for r in clean.collect())
    kept = decontamination.drop_contaminated(clashing, bench)
    assert kept.columns == clashing.columns and {r.doc_id for r in kept.collect()} == {1, 2, 3, 4, 8}


def test_decontamination_in_blocks_of_the_benchmark(spark, docs):
    items = [(k, " ".join(TEXT.split()[9 * k : 9 * k + 20])) for k in range(20)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    whole, parts = (
        sorted(decontamination.find_contamination(docs, bench, ["doc_id"], block_bytes=size).collect(), key=str)
        for size in (1 << 20, 150)
    )
    assert whole == parts


def test_licenses(docs, none, clashing):
    rows = by_id(licenses.digest(licenses.scan_licenses(docs)))
    assert (rows[8][0].labels, rows[8][0].base_labels, rows[8][0].n_base) == ("mit,reserved", "reserved", 1)
    assert [rows[k][0].n_words for k in (1, 2, 3, 4, 7)] == [0, 0, 0, 60_000, 1]
    assert rows[1][0].first_word is None and rows[1][0].labels == "" and rows[1][0].score == 0
    assert licenses.digest(licenses.scan_licenses(none)).count() == 0
    assert licenses.scan_licenses(clashing).count() == len(ROWS)


def test_license_join_finds_every_block_that_meets_a_template(spark):
    r = random.Random(1)
    wanted = licenses.templates()
    vocabulary = sorted({w for t in wanted for w in t.words})
    lines = [" ".join(r.sample(vocabulary, r.randint(3, 25))) for _ in range(150)]
    lines += [" ".join(r.sample(t.words, len(t.words))[r.randint(0, 2) :]) for t in wanted for _ in range(8)]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(lines)], "doc_id bigint, text string")
    for threshold in (0.6, 0.9):
        got = {x.doc_id: (set(x.labels) - {"cc-by", "gpl", "reserved"}) for x in licenses.scan_licenses(frame, threshold=threshold).collect()}
        for k, line in enumerate(lines):
            words = set(line.split())
            assert got[k] == {t.label for t in wanted if len(words & set(t.words)) >= t.need(threshold)}


def test_licenses_wrapped_over_lines(spark):
    """Notices at any width, as paragraphs of prose and comments have them; blank lines part them."""
    wrapped = {
        "bsd": "Copyright A\n\n// Redistribution and use in source and binary forms, with or without\n// modification, are permitted provided that\n",
        "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy\r\nof this software and associated documentation\r\n",
        "mpl-2.0": " * This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not\n",
    }
    r = random.Random(2)
    rows = [(label, text) for label, text in wrapped.items()]
    for label, notice in licenses.TEMPLATES:
        for width in (1, 2, 3, 5):
            words = notice.split()
            lines = [" ".join(words[k : k + width]) for k in range(0, len(words), width)]
            lines[0] = " ".join([*r.choices(WORDS, k=r.choice([0, 5, 40])), lines[0]])
            lines[-1] = " ".join([lines[-1], *r.choices(WORDS, k=r.choice([0, 5, 40]))])
            rows.append((label, "\n".join(lines)))
    rows += [
        ("isc", "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted,\nprovided that the above copyright notice and this permission notice\nappear in all copies.\n"),
        ("gpl-notice", "# This program is free software; you can redistribute it and/or\n# modify it under the terms of the GNU General Public License as published\n# by the Free Software Foundation; either version 2\n"),
    ]
    rows += [(None, "Released under the\n \nMIT License"), (None, "Released under the " + " ".join(WORDS[:40]) + "\nMIT License"), (None, "\n\n")]
    frame = spark.createDataFrame([(k, text) for k, (_, text) in enumerate(rows)], "doc_id bigint, text string")
    base = {label for _, label in licenses.PHRASES}
    database = duckdb.connect()
    database.register("documents", frame.toPandas())
    judged = {r[0]: (r[6], r[7]) for r in database.sql(ORACLE_SQL["op9_license_scans"]).fetchall()}
    for x in licenses.scan_licenses(frame).collect():
        assert judged[x.doc_id] == (",".join(x.labels), x.score)
        label, text = rows[x.doc_id]
        assert set(x.labels) - base == ({label} if label else set()), text
        assert x.score >= 0.9 if label else x.score == 0


def test_packing_and_token_files_beside_clashing_columns(spark, docs, clashing):
    columns = ["sequence_id", "offset", "piece", "start", "bin", "block", "shard", "segment", "words", "n_tokens"]
    clashing = clashing.withColumns({name: F.lit("x") for name in columns})
    made = []
    for frame in (docs, clashing):
        pieces = packing.digest(frame).drop("sequence_id", "offset").collect()
        path = scratch_path(spark, "clashing")
        token_files.write_token_files(frame, path)
        read = token_files.read_token_files(spark, path).select("doc_id", "start", "n_tokens", "ids").collect()
        made.append((sorted(pieces, key=str), sorted(read, key=str)))
    assert made[0] == made[1]


def test_packing(docs, none):
    packed = packing.pack(docs).collect()
    assert sum(r.length for r in packed if r.doc_id == 1) == 1
    assert sum(len(r.ids) // 4 for r in packed) == sum(r.length for r in packed)
    assert max(r.length for r in packed) == 4096
    assert packing.pack(none).count() == 0 and packing.digest(none).count() == 0


def test_plans_fill_bins():
    r = random.Random(0)
    for _ in range(20):
        counts = {r.randint(1, 100): r.randint(1, 30) for _ in range(r.randint(1, 12))}
        bins = packing.plan(counts, 100)
        used = {}
        for chosen, times in bins:
            assert sum(n * c for n, c in chosen.items()) <= 100
            for n, c in chosen.items():
                used[n] = used.get(n, 0) + c * times
        assert used == counts
    assert packing.fullest({7: 3, 5: 2, 4: 1}, 18) in ({7: 2, 4: 1}, {5: 2, 4: 1})


def test_token_files(spark, docs, none):
    for frame, count in ((docs, len(ROWS)), (none, 0)):
        path = scratch_path(spark, "files")
        token_files.write_token_files(frame, path)
        read = token_files.read_token_files(spark, path).orderBy("start").collect()
        assert len(read) == count
        at = 0
        for r in read:
            assert r.start == at and len(r.ids) == 4 * r.n_tokens
            at += r.n_tokens
        ids = [r.doc_id for r in read]
        assert ids == sorted(ids, key=lambda i: -1 if i is None else i)


@pytest.mark.parametrize("largest", [1, 2, 300, 50_000, 1 << 40, 1 << 63])
@pytest.mark.parametrize("count", [0, 1, 1023, 1024, 1025, 5000])
def test_simple8b_round_trip(count, largest):
    r = np.random.default_rng(count)
    values = r.integers(0, largest, count, dtype=np.uint64)
    values[r.random(count) < 0.5] %= np.uint64(9)
    words, first, escapes = simple8b.encode(values)
    assert (simple8b.decode(words, first, escapes, count) == values).all()
    ids, lengths, read = simple8b.unpack_segment(simple8b.pack_segment(np.array([3]), np.array([count]), values))
    assert ids.tolist() == [3] and lengths.tolist() == [count] and (read == values).all()


@pytest.mark.parametrize("letters", ["aAbΣσéÉ'st  \x85\x1c\x0b\x0c\t\n\r09.,İß̸=你", "abÀéñÆǅɐªº ,.%&'~­Ãµ×", "ab.,!?'^`´…<|>_-sS:;"])
def test_remembered_words_have_the_tokenizers_ids(letters):
    tokenizer = tokens.Tokenizer.from_file(tokens.default_path())
    r = random.Random(2)
    texts = ["".join(r.choice([*letters, "<|endoftext|>", " "]) for _ in range(r.randint(0, 14))) for _ in range(3000)]
    for text, packed in zip(texts, tokens.encode([t.encode() for t in texts], tokens.default_path())):
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(packed, "<u4").tolist() == [*want, tokens.END_ID], text


def test_a_text_of_more_words_than_the_table_has_places(monkeypatch):
    monkeypatch.setattr(tokens, "TABLE_BITS", 6)
    monkeypatch.setattr(tokens, "_tables", {})
    tokenizer = tokens.Tokenizer.from_file(tokens.default_path())
    texts = [" ".join(f"{k * 7919:x}," for k in range(500)), "", "one two, one", " ".join(f"n{k % 90}" for k in range(400))]
    for text, packed in zip(texts, tokens.encode([t.encode() for t in texts], tokens.default_path()), strict=True):
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(packed, "<u4").tolist() == [*want, tokens.END_ID]


def test_scores(spark, docs, none, clashing):
    labels = spark.createDataFrame([(k, (k or 0) % 2, (k or 0) % 2) for k in (4, 5, 6, 7, None)], "doc_id bigint, toxic int, quality int")
    for made in (
        toxicity.digest(docs, labels), toxicity.digest(docs, labels.limit(0)),
        cotraining.digest(docs, labels), cotraining.digest(docs, labels.limit(0)),
    ):
        rows = made.collect()
        assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
        assert all(not r.held_out for r in rows if r.doc_id is None)
    assert toxicity.digest(none, labels).count() == cotraining.digest(none, labels).count() == 0
    assert toxicity.score(clashing, toxicity.fit(clashing, labels), ["doc_id", "labels"]).count() == len(ROWS)


def test_toxicity_learns_words_and_their_misspellings(spark):
    r = random.Random(4)

    def text(*bad):
        words = r.choices(WORDS, k=80)
        for b in bad:
            words.insert(r.randrange(80), b)
        return " ".join(words)

    rows = [(k, text(*(["horrible", "dreadful"] if k % 3 == 0 else []))) for k in range(600)]
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k, _ in rows], "doc_id bigint, toxic int")
    tests = [(1000 + k, text("horible", "dredful", "horrable", "dreadfull") if k % 2 else text()) for k in range(40)]
    frame = spark.createDataFrame([*rows, *tests], "doc_id bigint, text string")
    got = by_id(toxicity.digest(frame, labels))
    right = sum(got[1000 + k][0].predicted == k % 2 for k in range(40))
    assert right >= 32


def test_toxicity_trains_on_long_texts_and_within_its_bound(spark, monkeypatch):
    rows = [(k, " ".join(WORDS[k % 40 : k % 40 + 9]) + (" horrible" * 30_000 if k % 2 else "")) for k in range(60)]
    labels = spark.createDataFrame([(k, k % 2) for k, _ in rows], "doc_id bigint, toxic int")
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert max(len(t) for _, t in rows) > 200_000
    odd = lambda: {k: r[0].predicted for k, r in by_id(toxicity.digest(frame, labels)).items()}
    assert odd() == {k: k % 2 for k, _ in rows}
    taken = []
    train = toxicity.train
    monkeypatch.setattr(toxicity, "FETCHED_BUCKETS", 200)
    assert odd() == {k: k % 2 for k, _ in rows}
    monkeypatch.setattr(toxicity, "SAMPLE_BUCKETS", 900)
    monkeypatch.setattr(toxicity, "train", lambda bags, *a, **k: taken.append(len(bags.bucket)) or train(bags, *a, **k))
    assert len(odd()) == len(rows) and 500 < taken[0] <= 900


def test_co_training_combines_views():
    r = np.random.default_rng(1)

    def rows(count):
        label = r.integers(0, 2, count)
        views = [np.column_stack([label + r.normal(0, 0.6, count), r.normal(size=count)]) for _ in range(2)]
        return views, label.astype(float)

    views, label = rows(200)
    pool, _ = rows(400)

    def exchange(models, k):
        told = [cotraining.sure(m, v) for m, v in zip(models, pool)]
        return [(pool[v][told[1 - v] >= 0], told[1 - v][told[1 - v] >= 0].astype(float)) for v in (0, 1)]

    model = cotraining.co_train(views, label, exchange)
    test, truth = rows(1000)
    assert ((model.score(*test) >= 0.5) == truth).mean() > 0.83


@pytest.mark.parametrize("given", [40, 6000])
def test_views_are_given_a_bounded_number_of_all_rows_that_one_is_sure_of(spark, monkeypatch, given):
    monkeypatch.setattr(cotraining, "GIVEN_ROWS", given)
    rows = [(k if k % 9 else None, "ab " * (1 + k % 7), k) for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint").union(
        spark.createDataFrame([(1, "ab ab ", 1)] * 5, "doc_id bigint, text string, n_chars bigint")
    )
    pool = cotraining.stored(cotraining._with_features(docs, "text", "doc_id", ()), "test")
    size = 256 + cotraining.EXTRA
    certain = [cotraining.Logistic(np.zeros(n), np.ones(n), np.zeros(n), bias) for n, bias in ((size, 9.0), (0, -9.0))]
    made = [cotraining._exchange(pool, ())(certain, k) for k in (0, 1)]
    different = len({(i, t) for i, t, _ in rows})
    for content_view, metadata_view in made:
        assert len(content_view[1]) == len(metadata_view[1]) == min(given, different)
        assert set(content_view[1]) == {0.0} and set(metadata_view[1]) == {1.0}  # each has the other's labels
    doubtful = [cotraining.Logistic(c.mean, c.spread, c.weight, 0.0) for c in certain]
    assert [len(g) for _, g in cotraining._exchange(pool, ())(doubtful, 0)] == [0, 0]


@pytest.mark.parametrize(
    "page, want",
    [
        ("", []),
        ("<p", []),
        ("a < b &lt; c&nbsp;d <b>bo</b>ld<p>two", [("a < b < c d bold", OTHER), ("two", OTHER)]),
        ("<nav>n</nav><article>A <span class='ad'>buy <span>x</span> y</span> B</article>", [("n", DROP), ("A", MAIN), ("buy x y", DROP), ("B", MAIN)]),
        ("<body class='has-sidebar'><div class=sidebar>s<main>m</main></div></body>", [("s", DROP), ("m", MAIN)]),
        ("<article>t</article><section id='comments'><article>c</article></section>", [("t", MAIN), ("c", DROP)]),
        ("<script>if (a<b) '</p>'</script><style>p{}</style>t<!-- c", [("t", OTHER)]),
        ("x</div></div><p>y<form>f</form>z", [("x", OTHER), ("y", OTHER), ("f", DROP), ("z", OTHER)]),
    ],
)
def test_blocks(page, want):
    assert blocks(page) == want


def test_pages(spark):
    frame = "<div>Menu</div><div>Welcome to our site</div><p>{}</p><div>Imprint</div>"
    rows = [(k, f"http://h.org/a/{k:03}", frame.format(f"text {k}")) for k in range(30)]
    rows += [(100, None, None), (101, "odd", ""), (102, "http://alone.org/", frame.format("alone")), (103, rows[0][1], rows[0][2]), (None, "http://h.org/z", "<article>t</article>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r for r in main_text.digest(main_text.extract(pages, ["page_id", "url"])).collect()}
    assert len(got) == len(rows)
    assert [got[k].text for k in range(1, 30)] == [f"text {k}" for k in range(1, 30)]
    assert got[100].text == got[101].text == "" and got[None].text == "t"
    assert got[102].text == "Menu Welcome to our site alone Imprint"  # nothing to compare it with
    assert main_text.extract(pages.limit(0), ["page_id"]).count() == 0


def test_differences_decide_where_an_article_holds_little(spark):
    def page(k, frame="Menu of the host that all of its pages repeat"):
        own = f"Page {k} tells at length what page {k} is about, {'and more ' * k}in a plain element."
        return f"<div>{frame}</div><article>Teaser {k}</article><div>{own}</div><div>Imprint</div>", f"Teaser {k} {own}"

    rows = [(k, f"http://h/{k}", page(k)[0]) for k in range(1, 6)]
    rows.append((9, "http://h/9", "<div>aside</div><article>" + "long " * 9 + "</article><div>Imprint</div>"))
    rows.append((10, "http://i/1", "<main class='search results'>found<div class='search'>form</div></main>"))
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r.main_text for r in main_text.extract(frame, ["page_id"]).collect()}
    assert got == {**{k: page(k)[1] for k in range(1, 6)}, 9: ("long " * 9).strip(), 10: "found"}


def test_pages_of_one_host_and_address_beside_clashing_columns(spark):
    """A hot address with repeated pages, an address with ties, and columns named as the operator's own."""
    frame = "<div>Menu of the host</div><div>{}</div><div>Imprint</div>"
    rows = [(k, "http://hot.org/a", frame.format("the same text")) for k in range(200)]
    rows += [(200 + k, "http://hot.org/b", frame.format(f"text {k}")) for k in range(200)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    names = ["_key", "_host", "_path", "_body", "host", "path", "row", "shared", "key", "before", "own_hashes", "main_text"]
    clashing = pages.withColumns({name: F.lit("x") for name in names})
    got = main_text.extract(clashing, ["page_id", *names]).collect()
    assert len(got) == 400 and {r["_key"] for r in got} == {r["host"] for r in got} == {"x"}
    texts = {r.page_id: r.main_text for r in got}
    assert [texts[200 + k] for k in range(200)] == [f"text {k}" for k in range(200)]
    assert {texts[k] for k in range(200)} == {"the same text"}


def test_common_subsequence():
    r = random.Random(0)
    for _ in range(200):
        a, b = ([r.randint(0, 4) for _ in range(r.randint(0, 9))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        assert len(main_text.common(a, b)) == best[-1][-1]


def test_unreported_measures_wait_for_the_rules_before_them(spark, docs):
    """The reported measures are made for all rows, the others only where no rule has rejected yet."""
    order = sorted(quality.RULES, key=lambda r: r.name in ("capitals", "stutter"))
    judged = quality.cascade(docs, order, report=quality.BASE)
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    plan = judged._jdf.queryExecution().analyzed().toString()
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    for name in ("_capitals", "_stutters"):
        line = next(x for x in plan.splitlines() if f"AS __q{name}#" in x)
        assert re.search(rf"CASE WHEN __q_left\d+#\d+ THEN .* AS __q{name}#", line), line
    for name in quality.BASE:
        line = next(x for x in plan.splitlines() if f"AS __q{name}#" in x)
        assert not re.search(rf"CASE WHEN __q_left\d+#\d+ THEN [^#]*AS __q{name}#", line)
    assert set(quality._below(quality.BASE)).isdisjoint({"_capitals", "_stutters"})


def test_sessions_keep_their_own_batches(spark, docs):
    from storelens.llm import frames

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    frames.stored(docs, "x")
    assert spark.conf.get(key) == "2000"
    spark.conf.set(key, "7")
    try:
        assert quality.keep_good(docs).count() > 0 and spark.conf.get(key) == "7"
    finally:
        spark.conf.set(key, "2000")
