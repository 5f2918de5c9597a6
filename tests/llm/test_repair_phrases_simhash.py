"""Conversation repair, phrase mining and SimHash against brute force, and their edge cases."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from storelens.llm import collocations, simhash, turn_costs, turn_repair
from storelens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


# --- conversation repair ---------------------------------------------------------------------

TURNS = "conv_id bigint, turn bigint, role string, text string"
BEHIND = {0: 2, 1: 2, 2: 3, 3: 2}
KEPT = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}


def repaired(rows):
    """The cheapest, then least audit, by trying all edits from the front."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for _, t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
    seen, faults = set(), []
    for _, role, text in rows:
        visible = re.findall(r"[^\x20\x09-\x0D]", text)
        last = visible[-1] if visible else ""
        faults.append("blank" if not visible else "duplicate" if (role, text) in seen else None if last in ".!?" else "truncated")
        seen.add((role, text))

    def grown(best):
        for _ in range(4):
            for state, (cost, audit, lines) in list(best.items()):
                role = "assistant" if state == 2 else "user"
                put(best, BEHIND[state], (cost + 2, audit + "I", (*lines, f"{role}:")))
        return best

    def put(best, state, option):
        if state not in best or option[:2] < best[state][:2]:
            best[state] = option

    best = grown({0: (0, "", ())})
    for (_, role, text), fault in zip(rows, faults):
        behind = {}
        for state, (cost, audit, lines) in best.items():
            put(behind, state, (cost + 3, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more = fault == "truncated"
            given = "assistant" if state == 2 else "user"
            put(behind, BEHIND[state], (cost + 2 + more, audit + "R", (*lines, f"{given}:{text}")))
            if (role[:1], state) in KEPT:
                put(behind, KEPT[role[:1], state], (cost + more, audit + "K", (*lines, f"{role}:{text}")))
        best = grown(behind)
    cost, audit, lines = min(best[s] for s in (0, 3) if s in best)
    turns = [t for t, _, _ in rows if t is not None]
    initials = [role[:1] for _, role, _ in rows]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    }


def some_turns():
    rnd, rows = random.Random(3), []
    roles = [["user", "assistant"], ["tool", "user"], ["tool"], ["system", "assistant"], ["user"], [None, "assistant", "", "sys"]]
    for conv in [*range(24), None]:
        for turn in range(rnd.choice([1, 2, 5, 9, 40, 120])):
            role = rnd.choice(roles[(conv or 3) % 6])
            text = rnd.choice([f"w{turn}.", "hi", "", "ok. \n", None, f"x{turn}"])
            rows.append((conv, rnd.choice([turn, turn, turn, None, 3]), role, text))
    return rows


def assert_repaired(df, rows, **options):
    by_conv = defaultdict(list)
    for row in rows:
        by_conv[row[0]].append(row)
    got = turn_repair.digest(turn_repair.repair(df, **options), df).collect()
    assert len(got) == len(by_conv)
    for row in got:
        assert row.asDict() == {"conv_id": row.conv_id, **repaired(by_conv[row.conv_id])}


@pytest.mark.parametrize("fixups", [0, 6])
def test_chunks_are_stitched(spark, fixups):
    """Chunks of four rows: by passes alone, and by matrices where passes do not end (tool runs)."""
    rows = some_turns()
    assert_repaired(spark.createDataFrame(rows, TURNS), rows, fixups=fixups, chunk_rows=4)


def test_whole_conversations_are_repaired(spark):
    rows = some_turns()
    assert_repaired(spark.createDataFrame(rows, TURNS), rows)


def test_vectors_converge():
    """Far from the end, vectors from different ends differ by a constant only."""
    stretch = turn_costs.Stretches([bytes([1, 2] * 20), bytes([3] * 40)])
    ends = [np.array([e, e]) for e in ([0, 4, 2, 0], [0, 0, 0, 0], [3, 0, 1, 2])]
    before = [stretch.before(e) for e in ends]
    assert (before[0][0] == before[1][0]).all() and (before[0][0] == before[2][0]).all()
    assert (before[0][1] != before[1][1]).any()  # unknown roles alone never settle
    assert (stretch.refit(ends[2], ends[0], before[0])[0] == before[2][0]).all()


def test_conversation_edges(spark):
    none = spark.createDataFrame([], TURNS)
    assert turn_repair.digest(turn_repair.repair(none), none).collect() == []
    assert turn_repair.damage(none).collect() == []
    # only nulls: blank rows, all deleted; void columns too
    nulls = spark.createDataFrame([(None, None, None, None)] * 3, TURNS)
    row = turn_repair.digest(turn_repair.repair(nulls), nulls).first()
    assert (row.conv_id, row.blank, row.audit, row.gaps, row.cost) == (None, 3, "DDD", 0, 9)
    long = "word " * 400_000
    rows = [(1, 0, "user", long), (1, 0, "user", long), (1, 1, "assistant", "Yes."), (1, 5, "tool", " \t\n")]
    df = spark.createDataFrame(rows, TURNS)
    assert_repaired(df, rows)
    names = ["edit", "place", "fault", "step", "_row", "_conv", "seq", "of", "code", "copy", "given", "edits"]
    clashing = df.withColumns({n: F.lit("x") for n in names})
    assert turn_repair.digest(turn_repair.repair(clashing), clashing).collect() == turn_repair.digest(turn_repair.repair(df), df).collect()
    # ids whose rows are all dropped stay
    assert {r.conv_id for r in turn_repair.digest(turn_repair.repair(none), df).collect()} == {1}


def test_repaired_rows(spark):
    rows = [(1, 0, "assistant", "A."), (1, 1, "user", "B."), (1, 1, "user", "B."), (1, 2, "user", "C")]
    edits = turn_repair.repair(spark.createDataFrame(rows, TURNS)).orderBy("place").collect()
    kept = [(r.edit, r.role, r.text) for r in edits if r.edit != "D"]
    assert [role for _, role, _ in kept] == ["user", "assistant"] * (len(kept) // 2)
    assert [r.fault for r in edits if r.edit != "I"] == [None, None, "duplicate", "truncated"]


# --- phrases ---------------------------------------------------------------------------------

PHRASE_DOCS = "doc_id bigint, text string, lang string"


def phrases(rows, least, top):
    counts, total = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(words)
            for m in range(1, 6):
                counts[lang or "und"].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, f in counts.items():
        n, found = total[lang], []
        frequent = {g: a for g, a in f.items() if a >= least and len(g) > 1}
        held = {g[s:e]: 0 for g in frequent for s in range(len(g)) for e in range(s + 1, len(g) + 1) if e - s < len(g)}
        for g, a in frequent.items():
            for s in range(len(g)):
                for e in range(s + 1, len(g) + 1):
                    if e - s < len(g):
                        held[g[s:e]] = max(held[g[s:e]], a)
        for g, a in frequent.items():
            score, _, left, right = min((1000 * a * n // (f[g[:k]] * f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
            if held.get(g, 0) < a:
                found.append((-score, -a, " ".join(g).encode(), left, right))
        for rank, (score, a, g, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, g.decode(), -a, left, right, n, -score))
    return sorted(out)


def phrase_docs():
    rnd, rows = random.Random(9), []
    words = [f"w{k}" for k in range(40)] + ["É", "ñ x", "B-c"]
    weights = [1 / (k + 1) for k in range(len(words))]
    passage = " ".join(rnd.choices(words, k=30))
    for doc in range(120):
        text = "".join(w + rnd.choice([" ", " ", "  ", "\t", ". ", ",", "\n"]) for w in rnd.choices(words, weights, k=rnd.choice([1, 30, 90])))
        rows.append((doc, text + (passage if doc % 5 == 0 else ""), rnd.choice(["en", "en", "de", None])))
    return rows


@pytest.mark.parametrize(("least", "top"), [(3, 2000), (2, 7)])
def test_phrases(spark, least, top):
    rows = phrase_docs()
    got = collocations.mine(spark.createDataFrame(rows, PHRASE_DOCS), least=least, top=top).collect()
    assert sorted(map(tuple, got)) == phrases(rows, least, top)


def test_rare_prefixes_settle_the_answer(spark, monkeypatch):
    """With enough phrases, first words whose bound is too low are never expanded."""
    rows = [(k, "rare pair. " + "the cat the dog " * 40, "en") for k in range(30)]
    seen = []
    plain = collocations.counted

    def counted(runs, grams, lengths, side, least):
        if side == collocations.RIGHT and lengths == [1]:
            seen.extend(r.a for r in grams.collect())
        return plain(runs, grams, lengths, side, least)

    monkeypatch.setattr(collocations, "counted", counted)
    got = collocations.mine(spark.createDataFrame(rows, PHRASE_DOCS), least=20, top=1).collect()
    assert sorted(map(tuple, got)) == phrases(rows, 20, 1)
    assert got[0].phrase == "rare pair" and max(seen) == 30


def test_phrase_edges(spark):
    none = spark.createDataFrame([], PHRASE_DOCS)
    assert collocations.mine(none).collect() == []
    rows = [(1, None, None), (2, "", "en"), (3, " .\t,", "en"), (None, "a b " * 200_000, None), (5, "A b", None), (5, "A b", None)]
    df = spark.createDataFrame(rows, PHRASE_DOCS)
    want = phrases(rows, 100, 2000)
    assert sorted(map(tuple, collocations.mine(df).collect())) == want and want
    clashing = df.withColumns({n: F.lit("x") for n in ("gram", "a", "n", "score", "word", "k", "l", "r", "low", "high", "__text")})
    assert sorted(map(tuple, collocations.mine(clashing).collect())) == want


def test_products_beyond_64_bits(spark):
    row = spark.range(1).selectExpr("7000000000000 as a", "90000000000001 as n", "8000000000003 as l", "7000000000011 as r")
    got = row.select(collocations._score("a", "n", "l", "r").alias("s")).first().s
    assert got == 1000 * 7000000000000 * 90000000000001 // (8000000000003 * 7000000000011)


# --- SimHash ---------------------------------------------------------------------------------


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(prints, radius=2):
    """Per place the class of those reachable by steps within the radius."""
    values, label = np.array(prints, np.uint64), list(range(len(prints)))
    for i, value in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(values ^ value) <= radius).tolist():
            a, b = label[i], label[j]
            if a != b:
                label = [min(a, b) if x in (a, b) else x for x in label]
    return label


def test_simhash(spark):
    docs = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet' order by doc_id").fetchall()
    prints = [fingerprint(t) for _, t in docs]
    label = linked(prints)
    want = {(i, f"{p:016x}", docs[c][0]) for (i, _), p, c in zip(docs, prints, label)}
    assert {tuple(r) for r in QUERIES["op13_simhash_dedup"](spark, SF).collect()} == want


@pytest.mark.parametrize("tile", [7, 8192])
def test_tiles_find_every_link(spark, tile):
    """Chains of steps of one, two and three bits, dense groups, and all cells near the corners."""
    rnd, values = random.Random(4), {0, 1, 3, 2**64 - 1, 2**64 - 2, 2**63, 2**63 + 2**47}
    for size in (1, 2, 3):
        for _ in range(40):
            value = rnd.getrandbits(64)
            for _ in range(rnd.choice([1, 4, 12])):
                values.add(value)
                for bit in rnd.sample(range(64), size):
                    value ^= 1 << bit
    dense = rnd.getrandbits(64)
    values |= {dense ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a)}
    values = sorted(values)
    signed = [(v - 2**64 if v >= 2**63 else v,) for v in values]
    edges = simhash.link_fingerprints(spark.createDataFrame(signed, "fp bigint"), tile=tile).collect()
    assert len(edges) < 30 * len(values)
    place, label = {v: i for i, (v,) in enumerate(signed)}, list(range(len(values)))
    for e in edges:
        a, b = label[place[e.a]], label[place[e.b]]
        label = [min(a, b) if x in (a, b) else x for x in label]
    assert label == linked(values)


def test_simhash_edges(spark):
    schema = "doc_id bigint, text string"
    assert simhash.similar_documents(spark.createDataFrame([], schema)).collect() == []
    long = " ".join(random.Random(2).choices([f"w{k}" for k in range(300)], k=200_000))
    rows = [(7, None), (3, ""), (5, " \t\n"), (None, "One two"), (9, "one TWO"), (4, long), (4, long), (8, long + " End")]
    df = spark.createDataFrame(rows, schema)
    got = simhash.similar_documents(df).collect()
    by_print = defaultdict(list)
    for r in got:
        by_print[r.fingerprint].append((r.doc_id, r.component_id))
    assert len(got) == len(rows)
    assert sorted(by_print[0]) == [(3, 3), (5, 3), (7, 3)]
    two = fingerprint("one two")
    assert {c for i, c in by_print[two - 2**64 if two >= 2**63 else two]} == {9}
    own = fingerprint(long)
    assert [c for i, c in by_print[own - 2**64 if own >= 2**63 else own] if i == 4] == [4, 4]
    clashing = df.withColumns({n: F.lit("x") for n in ("fp", "cell", "tile", "root", "lowest", "component_id", "fingerprint", "__text")})
    assert sorted(map(str, simhash.similar_documents(clashing).collect())) == sorted(map(str, got))
