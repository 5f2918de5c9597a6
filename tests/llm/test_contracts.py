"""Every operator's query against a plain re-computation of its contract over a whole table."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from storelens.llm import tokens
from storelens.llm.queries import ORACLE_SQL, QUERIES
from tools.compare import connect, difference

SF = "/root/testdata/sf0.001"
SPACE_WORD = r"[^\x20\x09-\x0D]+"
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


@pytest.fixture(scope="module")
def docs():
    return dict(duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall())


@pytest.fixture(scope="module")
def results(spark):
    made = {}

    def result(name):
        if name not in made:
            made[name] = [r.asDict() for r in QUERIES[name](spark, SF).collect()]
        return made[name]

    return result


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    assert difference(QUERIES[name](spark, SF), connect(SF), ORACLE_SQL[name]) == ""


def test_one_query_per_operator():
    numbers = [int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES]
    assert sorted(numbers) == list(range(1, 14))


def ids_of(docs):
    tokenizer = tokens.Tokenizer.from_file(tokens.default_path())
    return {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in docs.items()}


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files(docs, results):
    start = 0
    rows = {r["doc_id"]: r for r in results("op10_token_files")}
    for doc_id, ids in sorted(ids_of(docs).items()):
        assert rows[doc_id] == {"doc_id": doc_id, "start": start, "n_tokens": len(ids), "ids_crc32": crc(ids)}
        start += len(ids)


def test_packing(docs, results):
    ids = ids_of(docs)
    check_packing(results("op3_best_fit_packing"), ids)
    used = {r["sequence_id"] for r in results("op3_best_fit_packing")}
    # as few as there can be: all but the last are full
    assert len(used) == -(-sum(map(len, ids.values())) // 4096)


def check_packing(rows, ids):
    bins, seen = defaultdict(list), Counter()
    for r in rows:
        piece = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(piece) == r["length"] <= 4096 and crc(piece) == r["ids_crc32"]
        assert r["start"] == 4096 * r["piece"]
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
        seen[r["doc_id"]] += r["length"]
    assert seen == {i: len(x) for i, x in ids.items()}
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096


def shingles(text):
    words = re.findall(SPACE_WORD, lowered(text))
    return frozenset(tuple(words[k : k + 4]) for k in range(max(1, len(words) - 3))) if words else frozenset()


def components(docs, percent=85):
    sets = {i: shingles(t) for i, t in docs.items()}
    holders, up = defaultdict(list), {i: i for i in docs}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in sorted(sets):
        shared = Counter(j for gram in sets[i] for j in holders[gram])
        for j, n in shared.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
        for gram in sets[i]:
            holders[gram].append(i)
    return sets, {i: find(i) for i in docs}


def test_ngram_join(docs, results):
    sets, roots = components(docs)
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in results("op5_ngram_jaccard")} == {
        (i, len(sets[i]), roots[i]) for i in docs
    }
    assert len(set(roots.values())) < len(roots)


def cut(docs, length=400):
    """Per document the bytes that stay, and the number of removed runs."""
    raw = {i: (t or "").encode() for i, t in docs.items()}
    seen = Counter(b[k : k + length] for b in raw.values() for k in range(len(b) - length + 1))
    out = {}
    for i, b in raw.items():
        gone = np.zeros(len(b) + 1, int)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k] += 1
                gone[k + length] -= 1
        gone = np.cumsum(gone[:-1]) > 0
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out[i] = bytes(np.frombuffer(b, np.uint8)[~gone]), runs
    return out


def test_suffix_dedup(docs, results):
    kept = cut(docs)
    for r in results("op8_suffix_dedup"):
        size = len((docs[r["doc_id"]] or "").encode())
        rest, runs = kept[r["doc_id"]]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (size, size - len(rest), runs)
        assert r["kept_sha256"] == hashlib.sha256(rest).hexdigest()
    assert sum(r["n_removed"] for r in results("op8_suffix_dedup")) > 0


PHRASES = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}


def test_license_base(docs, results):
    for r in results("op9_license_scans"):
        words = re.findall(ALNUM_WORD, lowered(docs[r["doc_id"]]))
        places = [(i, label) for p, label in PHRASES.items() for i in range(len(words)) if tuple(words[i : i + len(p)]) == p]
        starts = [i for i, _ in places]
        labels = {label for _, label in places}
        assert r["n_words"] == len(words) and r["n_base"] == len(places)
        assert (r["first_word"], r["last_word"]) == (min(starts, default=None), max(starts, default=None))
        assert r["base_labels"] == ",".join(sorted(labels))
        assert labels <= set(filter(None, r["labels"].split(","))) and 0 <= r["score"] <= 1


def test_html_extraction(results):
    import html

    pages = duckdb.sql(f"select page_id, html from '{SF}/pages.parquet'").fetchall()
    texts = {r["page_id"]: r for r in results("op4_html_extraction")}
    for page_id, page in pages:
        article = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)[1]
        parts = re.split(r"<[^>]*>", re.sub(r"</?b>", "", article))
        want = " ".join(filter(None, (re.sub(r"\s+", " ", html.unescape(p)).strip() for p in parts)))
        assert texts[page_id]["text"] == want and texts[page_id]["n_chars"] == len(want)


@pytest.mark.parametrize("name", ["op2_toxicity", "op7_quality_classifier"])
def test_scores(docs, results, name):
    threshold = {"op2_toxicity": 0.3, "op7_quality_classifier": 0.5}[name]
    assert {r["doc_id"] for r in results(name)} == set(docs)
    for r in results(name):
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= threshold)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)


def area(scores, labels):
    """Share of pairs of a 1 and a 0 where the 1 scores higher; ties count half."""
    ranks = {s: (np.searchsorted(ordered, s) + np.searchsorted(ordered, s, "right") + 1) / 2 for ordered in [np.sort(scores)] for s in set(scores)}
    ones = [ranks[s] for s, y in zip(scores, labels) if y]
    return (sum(ones) - len(ones) * (len(ones) + 1) / 2) / (len(ones) * (len(labels) - len(ones)))


# 400 labels hold some 35 toxic texts to learn from, 4,000 ten times as many
@pytest.mark.parametrize(
    "name, label, size, least", [("op7_quality_classifier", "quality", "0.01", 0.97), ("op2_toxicity", "toxic", "0.1", 0.9)]
)
def test_held_out_labels(spark, name, label, size, least):
    folder = f"/root/testdata/sf{size}"
    truth = dict(duckdb.sql(f"select doc_id, {label} from '{folder}/labels.parquet' where {label} is not null").fetchall())
    rows = [r for r in QUERIES[name](spark, folder).where("held_out").collect() if r["doc_id"] in truth]
    assert len(rows) > 50
    assert area([r["score"] for r in rows], [truth[r["doc_id"]] for r in rows]) >= least


def test_pipeline(spark, docs, results):
    """Each stage against a plain computation on what the stage before it kept."""
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = frame.columns, docs
    stages = dict(corpus_pipeline.STAGES)

    def apply(name):
        nonlocal frame
        frame = corpus_pipeline.stored(stages[name](spark, frame, SF), "test")
        return {r["doc_id"]: r["text"] for r in frame.collect()}

    good = {r["doc_id"] for r in results("op1_quality_rules") if r["kept"]}
    after = apply("quality_rules")
    assert after == {i: t for i, t in before.items() if i in good} and frame.columns == columns
    before, after = after, apply("ngram_jaccard")
    roots = components(before)[1]
    assert after == {i: t for i, t in before.items() if roots[i] == i or not shingles(t)}
    before, after = after, apply("suffix_dedup")
    assert after == {i: k.decode("utf-8", "ignore") for i, (k, _) in cut(before, corpus_pipeline.PASSAGE_BYTES).items()}
    assert frame.columns == columns
    lengths = {r["doc_id"]: r["n_chars"] for r in frame.collect()}
    assert all(lengths[i] == len(t) for i, t in after.items())
    before, after = after, apply("benchmark_decontamination")
    items = [re.findall(ALNUM_WORD, lowered(t)) for (t,) in duckdb.sql(f"select text from '{SF}/benchmark.parquet'").fetchall()]
    windows = {tuple(w[k : k + m]) for w in items for m in [min(13, len(w))] for k in range(len(w) - m + 1) if m}
    for i, text in before.items():
        words = re.findall(ALNUM_WORD, lowered(text))
        hit = {p for m in {len(w) for w in windows} for k in range(len(words) - m + 1) if tuple(words[k : k + m]) in windows for p in range(k, k + m)}
        assert (i in after) == (not hit or 20 * len(hit) < len(words))
    rows = [r.asDict() for r in stages["best_fit_packing"](spark, frame, SF).collect()]
    check_packing(rows, ids_of(after))
