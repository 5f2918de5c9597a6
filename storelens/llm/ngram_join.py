"""N-gram Jaccard join: classes of documents linked by the similarity of their word n-gram sets.

1. Every text becomes its set of 64-bit n-gram hashes. Equal sets are one class from here on, so
   copies cost one row each.
2. Screening. The n-grams of the lowest quarter of hashes go, packed by bucket, to where their
   classes are counted. A class that has a partner shares all but a few of its n-grams, so one
   with too few shared n-grams in the quarter has none and goes no further.
3. The sets that remain are ordered by the number of classes that hold an n-gram, rarest first.
   Two similar sets share one of their first n-grams (prefix filter), and what lies behind the
   first one that they share is enough for the similarity (positional filter). Classes that share
   one where both filters hold, and those that do so with them, form a candidate group.
4. Each group is joined by a prefix tree (`prefix_tree`). A group beyond `GROUP_SETS` is cut into
   blocks; what a block leaves apart is then tried against every other block that holds one of its
   first n-grams where the filters hold, so no pair is left out.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.llm import prefix_tree
from storelens.llm.bytewords import SPACE_WORDS, U64, mix, ngram_hashes, word_hashes, words_of
from storelens.llm.frames import TEXT, field, map_texts, numbered, stored, text_column
from storelens.llm.graphs import components

WORDS = 4
PERCENT = 85
SAMPLE_BITS = 2  # n-grams whose upper bits are 0 are screened: a quarter
CLASSES_A_BUCKET = 4000
GROUP_SETS = 4000  # sets that one task joins; larger groups are cut into blocks
BLOCK_SETS = 2000
SIZE_STEP = 1.05  # sizes of sets are compared in classes, each larger by this factor
HAS_WORD = r"[^ \t-\r]"


def shingle_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of n consecutive words; fewer words make one, none make none."""
    words = words_of(texts, SPACE_WORDS, lower=True)
    hashes = word_hashes(words)
    grams = ngram_hashes(hashes, n)
    sets = []
    for first, last in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if last - first >= n:
            sets.append(np.unique(grams[first : last - n + 1]))
        else:
            sets.append(ngram_hashes(hashes[first:last], last - first) if last > first else grams[:0])
    return sets


def set_key(values: np.ndarray) -> int | None:
    """A 64-bit hash of a set."""
    if not len(values):
        return None
    parts = np.array([mix(values).sum(), mix(values ^ U64(0x5DEECE66D)).sum(), len(values)], U64)
    return int(ngram_hashes(parts, 3).view(np.int64)[0])


def spare(size: int | Column, percent: int):
    """Values of a set that a similar set may lack."""
    return size * (100 - percent) // 100 if isinstance(size, int) else F.floor(size * (100 - percent) / 100)


def _features(texts: list[bytes], n: int) -> dict[str, list]:
    sets = shingle_sets(texts, n)
    lowest = U64(1 << (64 - SAMPLE_BITS))
    return {
        "n_shingles": [len(s) for s in sets],
        "key": [set_key(s) for s in sets],
        "sample": [s[: np.searchsorted(s, lowest)].tobytes() for s in sets],
    }


def _identified(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """The ids as bigint and what identifies a row together with them."""
    body = text_column(docs, text)
    return docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.xxhash64(body).alias("_hash"), body.alias(TEXT))


def _packed(df: DataFrame, buckets: int) -> DataFrame:
    """Rows (bucket, values, keys): the values of all sets in column `set`, each with its set's key.

    Equal keys of a record batch go once; that is where copies are merged.
    """
    schema = "bucket int, values binary, keys binary"
    arrow = pa.schema([("bucket", pa.int32()), ("values", pa.binary()), ("keys", pa.binary())])

    def run(batches):
        for batch in batches:
            keys = batch.column("key").to_numpy()
            _, first = np.unique(keys, return_index=True)
            sets = [np.frombuffer(b, U64) for b in batch.column("set").take(pa.array(first)).to_pylist()]
            at = 0
            while at < len(sets):  # about 16 MB at a time
                sizes = np.cumsum([len(s) for s in sets[at:]])
                upto = at + max(1, int(np.searchsorted(sizes, 1 << 20)))
                values = np.concatenate(sets[at:upto])
                owners = np.repeat(keys[first[at:upto]], [len(s) for s in sets[at:upto]])
                at = upto
                bucket = (values % U64(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                bucket, values, owners = bucket[order], values[order], owners[order]
                bounds = np.flatnonzero(np.diff(bucket, prepend=-1))
                stops = [*bounds[1:].tolist(), len(bucket)]
                rows = {
                    "bucket": bucket[bounds],
                    "values": [values[a:b].tobytes() for a, b in zip(bounds.tolist(), stops)],
                    "keys": [owners[a:b].tobytes() for a, b in zip(bounds.tolist(), stops)],
                }
                yield pa.RecordBatch.from_pydict(rows, arrow)

    return df.select("key", "set").mapInArrow(run, schema)


def _unpacked(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (value, key) pairs sorted by value, the pair's run of equal values, and runs' lengths."""
    values = np.frombuffer(b"".join(table.column("values").to_pylist()), U64)
    keys = np.frombuffer(b"".join(table.column("keys").to_pylist()), np.int64)
    order = np.lexsort((keys, values))
    values, keys = values[order], keys[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (keys[1:] != keys[:-1])
    values, keys = values[new], keys[new]
    starts = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else new[:0]
    lengths = np.diff(np.append(starts, len(values)))
    return values, keys, np.repeat(np.arange(len(starts)), lengths), lengths


def _sent_home(buckets: int, keys: np.ndarray, **columns: np.ndarray) -> pa.Table:
    """The columns packed by the bucket of their keys: a row per bucket, however many keys there are."""
    home = (mix(keys.view(U64)) % U64(buckets)).astype(np.int32)
    order = np.argsort(home, kind="stable")
    home = home[order]
    bounds = np.flatnonzero(np.diff(home, prepend=-1))
    spans = list(zip(bounds.tolist(), [*bounds[1:].tolist(), len(home)]))
    packed = {name: [a[order][i:j].tobytes() for i, j in spans] for name, a in {"keys": keys, **columns}.items()}
    return pa.table({"home": pa.array(home[bounds], pa.int32()), **{n: pa.array(v, pa.binary()) for n, v in packed.items()}})


def _column(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


def _shared_counts(buckets: int) -> Callable[[pa.Table], pa.Table]:
    """Per bucket of keys: how many values of a bucket of values a key shares with other keys."""

    def count(table: pa.Table) -> pa.Table:
        _, keys, run, lengths = _unpacked(table)
        shared, hits = np.unique(keys[lengths[run] > 1], return_counts=True)
        return _sent_home(buckets, shared, hits=hits.astype(np.int64))

    return count


def _summed(table: pa.Table) -> pa.Table:
    keys, place = np.unique(_column(table, "keys", np.int64), return_inverse=True)
    hits = np.bincount(place, _column(table, "hits", np.int64), len(keys)).astype(np.int64)
    return pa.table({"key": keys, "hits": hits})


def _frequencies(buckets: int) -> Callable[[pa.Table], pa.Table]:
    """Per bucket of keys: the (key, classes that hold the value, value) of a bucket of values."""

    def weigh(table: pa.Table) -> pa.Table:
        values, keys, run, lengths = _unpacked(table)
        return _sent_home(buckets, keys, counts=lengths[run].astype(np.int64), values=values)

    return weigh


def _ordered_sets(percent: int) -> Callable[[pa.Table], pa.Table]:
    """Sets rarest value first, without those too few of whose values another set shares."""

    def order(table: pa.Table) -> pa.Table:
        keys, counts = _column(table, "keys", np.int64), _column(table, "counts", np.int64)
        values = _column(table, "values", U64)
        by = np.lexsort((values, counts, keys))
        keys, counts, values = keys[by], counts[by], values[by]
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else keys
        rows = {"key": [], "set": [], "length": [], "alone": [], "prefix": []}
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(keys)]):
            lacking = spare(b - a, percent)
            single = int(np.searchsorted(counts[a:b], 1, side="right"))
            if single <= lacking:
                rows["key"].append(int(keys[a]))
                rows["set"].append(values[a:b].tobytes())
                rows["length"].append(b - a)
                rows["alone"].append(single)
                rows["prefix"].append(values[a + single : a + lacking + 1].view(np.int64).tolist())
        kinds = [
            ("key", pa.int64()), ("set", pa.binary()), ("length", pa.int64()), ("alone", pa.int64()),
            ("prefix", pa.list_(pa.int64())),
        ]
        return pa.table(rows, pa.schema(kinds))

    return order


def _grouped(packed: DataFrame, by: str, function, schema: str) -> DataFrame:
    return packed.groupBy(by).applyInArrow(function, schema)


def link_classes(sets: DataFrame, percent: int, buckets: int) -> DataFrame:
    """Edges (a, b) that connect what links connect, of sets in columns key and set (sorted hashes)."""
    weighed = _grouped(
        _packed(sets, buckets), "bucket", _frequencies(buckets),
        "home int, keys binary, counts binary, values binary",
    )
    ordered = _grouped(
        weighed, "home", _ordered_sets(percent),
        "key bigint, set binary, length bigint, alone bigint, prefix array<bigint>",
    )
    ordered = stored(ordered, "ordered-sets")
    pairs = _heads(ordered, percent).select(F.col("key").alias("a"), F.col("least").alias("b"))
    groups = components(pairs).select(F.col("node").alias("key"), F.col("root").alias("group"))
    sizes = groups.groupBy("group").agg(F.count("*").alias("size"))
    members = ordered.select("key", "set").join(groups, "key").join(sizes, "group")
    members = stored(members.select("key", "set", "group", "size"), "groups")
    edges = stored(_join_blocks(members, percent, buckets), "links")
    large = members.where(F.col("size") > GROUP_SETS)
    if large.isEmpty():
        return edges
    return edges.union(_join_apart(large, ordered, edges, percent))


def _heads(ordered: DataFrame, percent: int) -> DataFrame:
    """Rows (key, value, length, reach, least): the first values of sets that may have a partner there.

    If the value is the first that two sets share, each has at most what lies from its place on in
    common with the other. `reach` is the size of the largest set that this is enough for, so both
    sets must be within the other's reach. A value's holders are summed up by classes of sizes, of
    which there are a few hundred, and each holder looks for a class with a partner in it. `least`
    is the smallest key that holds the value.
    """
    heads = ordered.select("key", "length", "alone", F.posexplode("prefix").alias("at", "value"))
    reach = F.expr(f"{100 + percent} * (length - alone - at) div {percent} - length")
    band = F.floor(F.log("length") / F.log(F.lit(SIZE_STEP)))
    heads = heads.select("key", "value", "length", reach.alias("reach"), band.alias("band"))
    bands = heads.groupBy("value", "band").agg(
        F.min("length").alias("shortest"), F.max("reach").alias("furthest"),
        F.count("*").alias("n"), F.min("key").alias("least"),
    )
    holders = bands.groupBy("value").agg(
        F.collect_list(F.struct("band", "shortest", "furthest", "n")).alias("bands"),
        F.min("least").alias("least"), F.sum("n").alias("n"),
    )
    heads = heads.join(holders.where("n > 1"), "value")
    partner = F.expr(
        "exists(bands, b -> b.shortest <= reach and b.furthest >= length and (b.n > 1 or b.band <> band))"
    )
    return heads.where(partner).select("key", "value", "length", "reach", "least")


EDGES = "a bigint, b bigint"


def _sets_of(table: pa.Table) -> tuple[np.ndarray, list[np.ndarray]]:
    return table.column("key").to_numpy(), [np.frombuffer(b, U64) for b in table.column("set").to_pylist()]


def _edges(keys: np.ndarray, roots: np.ndarray) -> pa.Table:
    apart = roots != np.arange(len(roots))
    return pa.table({"a": keys[apart], "b": keys[roots[apart]]})


def _join_blocks(members: DataFrame, percent: int, buckets: int) -> DataFrame:
    """Links within groups; those beyond GROUP_SETS block by block."""
    blocks = F.ceil(F.col("size") / BLOCK_SETS)
    block = F.when(F.col("size") > GROUP_SETS, F.pmod(F.xxhash64("key"), blocks)).otherwise(-1)
    # small groups share a task
    task = F.when(F.col("size") > 200, F.col("group")).otherwise(F.pmod(F.xxhash64("group"), F.lit(buckets)))
    dealt = members.select("key", "set", "group", block.alias("block"), task.alias("task"), (F.col("size") > 200).alias("own"))

    def join(table: pa.Table) -> pa.Table:
        keys, sets = _sets_of(table)
        group = table.column("group").to_numpy()
        made = [_edges(keys[:0], np.zeros(0, np.int64))]
        order = np.argsort(group, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(group[order])) + 1) if len(order) else []:
            links = prefix_tree.link_all([sets[i] for i in part], percent)
            made.append(_edges(keys[part], links.roots()))
        return pa.concat_tables(made)

    return dealt.groupBy("own", "task", "block").applyInArrow(join, EDGES)


def _join_apart(large: DataFrame, ordered: DataFrame, edges: DataFrame, percent: int) -> DataFrame:
    """Links in large groups between what their blocks have left apart.

    The sets outside a group's largest component so far are tried against the other blocks of the
    group that hold one of their heads (`_heads`) within reach. A block with more such probes than
    `BLOCK_SETS` meets them in parts.
    """
    known = components(edges).select(F.col("node").alias("key"), F.col("root").alias("root"))
    rows = large.join(known, "key", "left").withColumn("root", F.coalesce("root", "key"))
    rows = stored(rows.withColumn("block", F.pmod(F.xxhash64("key"), F.ceil(F.col("size") / BLOCK_SETS))), "blocks")
    weights = rows.groupBy("group", "root").agg(F.count("*").alias("n"))
    main = weights.groupBy("group").agg(F.max_by("root", F.struct("n", "root")).alias("main"))
    places = rows.join(main, "group").select("key", "group", "block", (F.col("root") != F.col("main")).alias("apart"))
    heads = _heads(ordered.join(rows.select("key"), "key", "left_semi"), percent).join(places, "key")
    held = heads.groupBy("group", "value", "block").agg(
        F.min("length").alias("shortest"), F.max("reach").alias("furthest")
    )
    own = heads.where("apart").withColumnRenamed("block", "own")
    meets = own.join(held, ["group", "value"]).where("block <> own and shortest <= reach and furthest >= length")
    met = stored(meets.select("key", "group", "block").distinct(), "probes")
    parts = met.groupBy("group", "block").agg(F.ceil(F.count("*") / BLOCK_SETS).alias("parts"))
    kinds = ["key", "set", "group", "root", "block", "part"]
    part = F.pmod(F.xxhash64(F.lit(1), "key"), "parts").alias("part")
    probes = rows.drop("block").join(met, ["group", "key"]).join(parts, ["group", "block"])
    probes = probes.select("key", "set", "group", "root", "block", part, F.lit(True).alias("probe"))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part")
    targets = rows.join(parts, ["group", "block"]).select("key", "set", "group", "root", "block", every)
    dealt = targets.select(*kinds, F.lit(False).alias("probe")).union(probes.select(*kinds, "probe"))

    def join(table: pa.Table) -> pa.Table:
        probe = table.column("probe").to_numpy(zero_copy_only=False)
        order = np.argsort(probe, kind="stable")
        table = table.take(pa.array(order))
        keys, sets = _sets_of(table)
        roots = table.column("root").to_numpy()
        cut = int((~probe).sum())
        links = prefix_tree.link_probes(sets[:cut], sets[cut:], percent, roots.tolist())
        return _edges(keys, links.roots())

    return dealt.groupBy("group", "block", "part").applyInArrow(join, EDGES)


def similar_documents(
    docs: DataFrame,
    *,
    text: str = "text",
    doc_id: str = "doc_id",
    n: int = WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, and _hash of its text.

    Texts with as many shared n-grams as `percent` per cent of their union link, and component_id is
    the smallest doc_id that links lead to. A text without words, or null, links with nothing and
    keeps its own id. Equal texts, repeated rows and repeated ids are separate rows of one
    component; a null id never is a component's id unless all ids in it are null. No rows, no rows.
    """
    rows = _identified(docs, text, doc_id)
    fields = [field("n_shingles", "bigint"), field("key", "bigint"), field("sample", "binary")]
    features = stored(
        map_texts(rows, TEXT, ["doc_id", "_hash"], fields, lambda texts: _features(texts, n)), "shingles"
    )
    filled = features.where("key is not null")
    classes = filled.groupBy("key").agg(
        F.min("doc_id").alias("lowest"),
        F.min(F.struct(F.coalesce("doc_id", F.lit(0)).alias("id"), "_hash")).alias("pick"),
        F.first("n_shingles").alias("n"),
        F.first(F.octet_length("sample") / 8).alias("sampled"),
    )
    classes = stored(classes, "classes")
    buckets = max(8, -(-classes.count() // CLASSES_A_BUCKET))
    samples = filled.select("key", F.col("sample").alias("set"))
    counted = _grouped(
        _packed(samples, buckets), "bucket", _shared_counts(buckets), "home int, keys binary, hits binary"
    )
    hits = _grouped(counted, "home", _summed, "key bigint, hits bigint")
    enough = F.coalesce("hits", F.lit(0)) >= F.col("sampled") - spare(F.col("n"), percent)
    left = classes.join(hits, "key", "left").where(enough).select("key", "pick.id", "pick._hash")
    texts = rows.withColumn("id", F.coalesce("doc_id", F.lit(0))).join(left, ["id", "_hash"]).select("key", TEXT)
    sets = map_texts(
        texts, TEXT, ["key"], [field("set", "binary")],
        lambda t: {"set": [s.tobytes() for s in shingle_sets(t, n)]},
    )
    edges = link_classes(stored(sets, "sets"), percent, buckets)
    roots = components(edges).select(F.col("node").alias("key"), "root")
    labelled = classes.select("key", "lowest").join(roots, "key", "left")
    labelled = labelled.withColumn("root", F.coalesce("root", "key"))
    lowest = labelled.groupBy("root").agg(F.min("lowest").alias("component_id"))
    of_key = stored(labelled.join(lowest, "root").select("key", "component_id"), "components")
    joined = features.drop("sample").join(of_key, "key", "left")
    return joined.select(
        "doc_id", "n_shingles", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "_hash"
    )


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """The documents with the smallest id of each component, and all without words, with their columns.

    Of rows with equal id and text one stays; of equal ids with similar texts the smallest hash.
    """
    rows, names = numbered(docs)
    own, body = names[doc_id], text_column(rows, names[text])
    found = similar_documents(rows.select(own, names[text]), text=names[text], doc_id=own, **options)
    known = F.struct(F.coalesce("doc_id", F.lit(0)).alias("_id"), F.col("_hash"))
    firsts = found.where("n_shingles > 0").groupBy("component_id").agg(
        F.min(F.struct(F.col("doc_id").isNull(), known.alias("known"))).alias("first")
    )
    picks = firsts.select("first.known._id", "first.known._hash")
    has_word = F.coalesce(body, F.lit("")).rlike(HAS_WORD)
    worded = rows.where(has_word).withColumns(
        {"_id": F.coalesce(F.col(own).cast("bigint"), F.lit(0)), "_hash": F.xxhash64(body)}
    )
    kept = worded.join(picks, ["_id", "_hash"], "left_semi").dropDuplicates(["_id", "_hash"])
    return kept.select(*rows.columns).union(rows.where(~has_word)).toDF(*docs.columns)
