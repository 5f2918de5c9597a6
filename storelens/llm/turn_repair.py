"""Conversation structure repair: the cheapest edits after which the roles read `(s?(ua)+)?`.

Rank-convergence parallel Viterbi. Rows in order become chunks of at most 1,024 codes; a
conversation of any length is many chunks, which tasks work on by themselves. Costs are computed
from the end. Every chunk but the last starts from a speculative vector, the one at the end of a
conversation. In a fix-up pass a chunk whose right neighbour's vector differs from the one it
started with by more than a constant runs again, until no chunk is left. Some rows never make
vectors alike (a long run of unknown roles); after a few passes what is left is settled by products
of the chunks' cost matrices over spans that double. With the stitched costs each chunk says which
state every start leads to, starts are composed over doubling spans too, and the edits are traced.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.llm import turn_costs
from storelens.llm.frames import numbered, stored
from storelens.llm.turn_costs import DELETE_COST, END, FORCED, INSERT_COST, REROLE_COST, TRUNCATED_COST, Stretches

CHUNK_ROWS = 1024
FIXUPS = 6  # passes before matrices settle the rest
CELLS = 1 << 19  # rows, padding included, that are worked on at a time
SPACES = " \t\n\x0b\x0c\r"
SENTENCE_ENDS = (".", "!", "?")
BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"
ORDER = ("_turn", "_role", "_mark", "_row")
CHUNKS = "conv string, part int, local int, codes binary, rows binary"


def damage(conversations: DataFrame) -> DataFrame:
    """The rows with the faults that crc32(`conv_id:turn`) % 20 names; nulls are one space there and
    in role and text. Columns conv_id, turn, role, text."""
    spaced = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    code = F.crc32(F.concat_ws(":", spaced["conv_id"], spaced["turn"])) % 20
    rows = conversations.select("conv_id", "turn", spaced["role"].alias("role"), spaced["text"].alias("text"), code.alias("code"))
    copies = F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", "".join(SENTENCE_ENDS), "")).otherwise(F.col("text"))
    role = F.when(F.col("code") == 4, "user").otherwise(F.col("role"))
    return rows.where("code <> 0").withColumn("copy", F.explode(copies)).select("conv_id", "turn", role.alias("role"), text.alias("text"))


def _key(column: str) -> Column:
    """A conversation's id as a string that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def _marked(rows: DataFrame) -> DataFrame:
    """Rows with what orders them and what is wrong with them by themselves."""
    trimmed = F.rtrim("text", F.lit(SPACES))
    return rows.select(
        _key("conv_id").alias("_conv"), "conv_id", F.col("turn").alias("_turn"), F.col("role").alias("_role"),
        F.md5("text").alias("_mark"), F.monotonically_increasing_id().alias("_row"), "text",
        (trimmed == "").alias("_blank"), (~F.right(trimmed, F.lit(1)).isin(*SENTENCE_ENDS)).alias("_open"),
    )


def _faults(marked: DataFrame) -> DataFrame:
    """The rows without their texts, each with its first fault.

    The first row of each role and text is found by a grouping, which shrinks a text that many rows
    share where it is read, and meets the rows again by their numbers.
    """
    light = marked.drop("text", "conv_id")
    first = F.min(F.struct("_turn", "_row"))["_row"].alias("_row")
    firsts = light.where("not _blank").groupBy("_conv", "_role", "_mark").agg(first).select("_row", F.lit(True).alias("_first"))
    fault = (
        F.when(F.col("_blank"), BLANK).when(F.col("_first").isNull(), DUPLICATE).when(F.col("_open"), TRUNCATED)
    )
    return light.join(firsts, "_row", "left").select("_conv", *ORDER, fault.alias("_fault"))


def _chunks(light: DataFrame, size: int) -> DataFrame:
    """Rows in order as chunks: per task and conversation numbered from 0."""
    role = F.coalesce(F.nullif(F.instr(F.lit("sua"), F.left("_role", F.lit(1))), F.lit(0)), F.lit(4)) - 1
    role = F.when(F.col("_role") == "", 3).otherwise(role)
    code = F.when(F.col("_fault").isin(BLANK, DUPLICATE), FORCED).when(F.col("_fault") == TRUNCATED, role + 4).otherwise(role)
    keys = ["_conv", *ORDER]
    ordered = light.withColumn("_code", code.cast("int")).repartitionByRange(*keys).sortWithinPartitions(*keys)

    def run(batches):
        part, now, local = TaskContext.get().partitionId(), None, 0
        codes, rows, held, made = [], [], 0, []

        def close():
            nonlocal codes, rows, held, local
            if held:
                made.append((now, part, local, np.concatenate(codes).tobytes(), np.concatenate(rows).tobytes()))
                codes, rows, held, local = [], [], 0, local + 1

        for batch in batches:
            conv = batch.column("_conv").to_pylist()
            code, row = batch.column("_code").to_numpy().astype(np.uint8), batch.column("_row").to_numpy()
            cuts = [0, *(k for k in range(1, len(conv)) if conv[k] != conv[k - 1]), len(conv)]
            for a, b in zip(cuts, cuts[1:]):
                if a < b and conv[a] != now:
                    close()
                    now, local = conv[a], 0
                while a < b:
                    upto = min(b, a + size - held)
                    codes.append(code[a:upto])
                    rows.append(row[a:upto])
                    held, a = held + upto - a, upto
                    if held == size:
                        close()
            yield _chunk_batch(made)
            made = []
        close()
        yield _chunk_batch(made)

    return ordered.select("_conv", "_code", "_row").mapInArrow(run, CHUNKS)


def _chunk_batch(made: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*made)) or [[]] * 5
    kinds = (pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["conv", "part", "local", "codes", "rows"])


def _in_sequence(chunks: DataFrame) -> DataFrame:
    """Chunks with their number in the conversation, and how many it has."""
    # a row per conversation and task that holds some of it: no window is longer than there are tasks
    counts = chunks.groupBy("conv", "part").agg(F.count("*").alias("n"))
    own = Window.partitionBy("conv")
    earlier = own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("conv", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"), F.sum("n").over(own).alias("of"))
    return chunks.join(counts, ["conv", "part"]).select("conv", (F.col("before") + F.col("local")).alias("seq"), "of", "codes", "rows")


def _each_stretch(frame: DataFrame, keep: list[str], fields: str, work) -> DataFrame:
    """`work` gets the Stretches of some chunks and their batch, and returns arrays of `fields`."""
    schema = T.StructType([frame.schema[k] for k in keep] + list(T._parse_datatype_string(fields)))

    def run(batches):
        for batch in batches:
            codes = batch.column("codes").to_pylist()
            order = sorted(range(len(codes)), key=lambda k: -len(codes[k]))
            at = 0
            while at < len(order):
                some = order[at : at + max(1, CELLS // len(codes[order[at]]))]
                at += len(some)
                part = batch.take(pa.array(some))
                made = work(Stretches([codes[k] for k in some]), part)
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keep), *made], names=schema.names)

    return frame.mapInArrow(run, schema)


def _vectors(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return np.array(batch.column(column).to_pylist(), np.int64).reshape(batch.num_rows, -1)


def _lists(values: np.ndarray) -> pa.Array:
    return pa.array(values.tolist(), pa.list_(pa.int32()))


def _array(values) -> Column:
    return F.array(*(F.lit(int(v)) for v in values)).cast("array<int>")


def _speculated(many: DataFrame) -> DataFrame:
    def work(stretches, batch):
        return [_lists(stretches.before(np.tile(END, (batch.num_rows, 1))))]

    made = _each_stretch(many.select("conv", "seq", "of", "codes"), ["conv", "seq", "of"], "ahead array<int>", work)
    return made.withColumn("ends", _array(END))


def _refitted(redo: DataFrame) -> DataFrame:
    def work(stretches, batch):
        return [_lists(stretches.refit(_vectors(batch, "fresh"), _vectors(batch, "ends"), _vectors(batch, "ahead")))]

    made = _each_stretch(redo, ["conv", "seq", "of", "fresh"], "again array<int>", work)
    return made.select("conv", "seq", "of", F.col("again").alias("ahead"), F.col("fresh").alias("ends"))


def _settled(many: DataFrame, last: int) -> DataFrame:
    """The vector behind each chunk by products of matrices over doubling spans."""

    def work(stretches, batch):
        return [_lists(stretches.matrices().reshape(batch.num_rows, 16))]

    spans = stored(_each_stretch(many.select("conv", "seq", "of", "codes"), ["conv", "seq", "of"], "m array<int>", work), "spans")

    def doubled(batches):
        for batch in batches:
            a, b = (_vectors(batch.filter(batch.column("next").is_valid()), c).reshape(-1, 4, 4) for c in ("m", "next"))
            out = np.array(batch.column("m").to_pylist(), np.int64).reshape(-1, 16)
            out[batch.column("next").is_valid().to_numpy(zero_copy_only=False)] = turn_costs.times(a, b).reshape(-1, 16)
            # a matrix is needed up to a constant only
            out = np.minimum(out - out.min(axis=1, keepdims=True), turn_costs.NEVER)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv", "seq", "of")), _lists(out)], names=["conv", "seq", "of", "m"])

    step = 1
    while step < last:
        further = spans.select("conv", (F.col("seq") - step).alias("seq"), F.col("m").alias("next"))
        spans = stored(spans.join(further, ["conv", "seq"], "left").mapInArrow(doubled, spans.schema), "spans")
        step *= 2
    # the span from the next chunk to the end, applied to the vector there
    closing = [F.array_min(F.array(*(F.col("m")[4 * i + j] + int(END[j]) for j in range(4)))) for i in range(4)]
    behind = spans.select("conv", (F.col("seq") - 1).alias("seq"), F.array(*closing).alias("v"))
    behind = behind.select("conv", "seq", F.transform("v", lambda x: x - F.array_min("v")).alias("ends"))
    ends = many.select("conv", "seq", "of").join(behind, ["conv", "seq"], "left")
    return ends.withColumn("ends", F.coalesce("ends", _array(END)))


def _stitched(many: DataFrame, last: int, fixups: int) -> DataFrame:
    """Columns conv, seq, of, ends: the vector behind every chunk, up to a constant."""
    vectors = stored(_speculated(many), "vectors")
    for _ in range(fixups):
        fresh = vectors.select("conv", (F.col("seq") - 1).alias("seq"), F.col("ahead").alias("fresh"))
        stale = vectors.join(fresh, ["conv", "seq"]).where("fresh <> ends")
        stale = stored(stale.join(many.select("conv", "seq", "codes"), ["conv", "seq"]), "stale")
        if stale.isEmpty():
            return vectors
        redone = _refitted(stale)
        rest = vectors.join(stale.select("conv", "seq"), ["conv", "seq"], "left_anti")
        vectors = stored(rest.unionByName(redone), "vectors")
    return _settled(many, last)


def _started(many: DataFrame, last: int) -> DataFrame:
    """Chunks with the state that each starts in: what the chunks before it lead to."""

    def work(stretches, batch):
        ends = _vectors(batch, "ends")
        behind = [stretches.trace(ends, np.full(batch.num_rows, s))[1] for s in range(4)]
        return [_lists(np.stack(behind, axis=1))]

    frame = many.select("conv", "seq", "codes", "ends")
    maps = stored(_each_stretch(frame, ["conv", "seq"], "leads array<int>", work), "maps")
    step = 1
    while step < last:
        before = maps.select("conv", (F.col("seq") + step).alias("seq"), F.col("leads").alias("first"))
        both = F.transform("first", lambda s: F.element_at("leads", s + 1))
        maps = stored(maps.join(before, ["conv", "seq"], "left").select("conv", "seq", F.coalesce(both, "leads").alias("leads")), "maps")
        step *= 2
    starts = maps.select("conv", (F.col("seq") + 1).alias("seq"), F.col("leads")[0].alias("start"))
    return many.join(starts, ["conv", "seq"], "left").withColumn("start", F.coalesce("start", F.lit(0)))


def _traced(chunks: DataFrame) -> DataFrame:
    """Per row its number, its edits and the roles that they give."""
    words = [pa.array(v) for v in (turn_costs.EDITS, turn_costs.ROLES)]

    def run(batches):
        for batch in batches:
            codes = batch.column("codes").to_pylist()
            order = sorted(range(len(codes)), key=lambda k: -len(codes[k]))
            at = 0
            while at < len(order):
                some = order[at : at + max(1, CELLS // len(codes[order[at]]))]
                at += len(some)
                part = batch.take(pa.array(some))
                starts = part.column("start").to_numpy().astype(np.int64)
                places, behind = Stretches([codes[k] for k in some]).trace(_vectors(part, "ends"), starts)
                closing = np.where(part.column("closes").to_numpy(zero_copy_only=False), turn_costs.CLOSING[behind], 0)
                labels = pa.array(np.concatenate([turn_costs.label(*p, c) for *p, c in zip(*places, closing.tolist())]))
                rows = np.frombuffer(b"".join(part.column("rows").to_pylist()), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(rows), *(w.take(labels) for w in words)], names=["_row", "edits", "roles"])

    source = chunks.select("codes", "rows", "ends", "start", (F.col("seq") == F.col("of") - 1).alias("closes"))
    return source.mapInArrow(run, "_row bigint, edits string, roles string")


def repair(
    conversations: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    fixups: int = FIXUPS, chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """One row per edit: conv_id, turn, place (orders a conversation's edits), edit (D, I, K or R),
    role and text after it (null if deleted, an empty text if inserted), and for the row that was
    there its fault (blank, duplicate, truncated or null) and role before.

    Rows follow their turn, null first, then role and text's md5. Null ids are a conversation; null
    roles and texts are one space. Equal rows are duplicates, all but one are deleted. A conversation
    that nothing can be made of at less cost loses all rows. No rows, no rows.
    """
    rows, names = numbered(conversations)
    spaced = {k: F.coalesce(F.col(names[c]).cast("string"), F.lit(" ")).alias(k) for k, c in (("role", role), ("text", text))}
    source = rows.select(F.col(names[conv_id]).alias("conv_id"), F.col(names[turn]).alias("turn"), spaced["role"], spaced["text"])
    marked = stored(_marked(source), "turns")
    light = stored(_faults(marked), "turn-faults")
    chunks = stored(_in_sequence(stored(_chunks(light, chunk_rows), "turn-chunks")), "turn-sequence")
    whole = chunks.where("of = 1").withColumn("ends", _array(END)).withColumn("start", F.lit(0))
    many = chunks.where("of > 1")
    last = many.agg(F.max("of")).first()[0]
    if last:
        stitched = stored(_stitched(many, last, fixups).select("conv", "seq", "ends"), "stitched")
        whole = whole.unionByName(_started(many.join(stitched, ["conv", "seq"]), last))
    edits = _traced(whole).join(light.select("_row", "_fault"), "_row")
    told = marked.join(edits, "_row").withColumn("step", F.explode(F.sequence(F.lit(1), F.length("edits"))))
    edit, given = (F.substr(c, F.col("step"), F.lit(1)) for c in ("edits", "roles"))
    told = told.withColumns({"edit": edit, "given": given})
    new_role = F.when(F.col("given") == "u", "user").when(F.col("given") == "a", "assistant").when(F.col("given") == "=", F.col("_role"))
    new_text = F.when(F.col("edit") == "I", "").when(F.col("edit") != "D", F.col("text"))
    inserted = F.col("edit") == "I"
    return told.select(
        "conv_id", F.col("_turn").alias("turn"), F.struct(*ORDER, "step").alias("place"), "edit", new_role.alias("role"), new_text.alias("text"),
        F.when(~inserted, F.col("_fault")).alias("fault"), F.when(~inserted, F.col("_role")).alias("role_before"),
    )


REPORT = T.StructType(
    [T.StructField("conv", T.StringType())]
    + [T.StructField(n, T.LongType()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    + [T.StructField(n, T.StringType()) for n in ("audit", "repaired_sha256")]
)
LEGAL = {"su", "ua", "au"}
COSTS = {"I": INSERT_COST, "D": DELETE_COST, "K": 0, "R": REROLE_COST}


class _Report:
    """What is told of one conversation, from its edits in order."""

    def __init__(self, conv):
        self.conv = conv
        self.low = self.high = self.turn = None
        self.turns = self.illegal = self.cost = self.repaired = 0
        self.faults = dict.fromkeys((BLANK, DUPLICATE, TRUNCATED), 0)
        self.before = None
        self.audit, self.hash = [], hashlib.sha256()

    def add(self, turn, edit, role, text, fault, role_before):
        self.audit.append(edit)
        self.cost += COSTS[edit]
        if edit != "I":
            if turn is not None and turn != self.turn:
                self.low = turn if self.low is None else self.low
                self.turn = self.high = turn
                self.turns += 1
            initial = role_before[:1]
            if self.before is not None and self.before + initial not in LEGAL:
                self.illegal += 1
            self.before = initial
            if fault:
                self.faults[fault] += 1
                self.cost += TRUNCATED_COST if fault == TRUNCATED and edit != "D" else 0
        if edit != "D":
            self.hash.update(f"{chr(10) if self.repaired else ''}{role}:{text}".encode())
            self.repaired += 1

    def row(self):
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())


def digest(edits: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per conversation id of `conversations`.

    A hash over a whole conversation can only be taken from its first row to its last, so its edits
    stream through one task in order; the task holds one batch of rows and the audit.
    """

    def run(batches):
        now = None
        for batch in batches:
            done = []
            for conv, *row in zip(*(batch.column(k).to_pylist() for k in range(batch.num_columns))):
                if now is None or conv != now.conv:
                    if now:
                        done.append(now.row())
                    now = _Report(conv)
                now.add(*row)
            yield _report_batch(done)
        yield _report_batch([now.row()] if now else [])

    columns = ["turn", "edit", "role", "text", "fault", "role_before"]
    keyed = edits.select(_key("conv_id").alias("conv"), *columns, "place")
    ordered = keyed.repartition("conv").sortWithinPartitions("conv", "place")
    told = ordered.select("conv", F.col("turn").cast("bigint"), *columns[1:]).mapInArrow(run, REPORT)
    ids = conversations.select("conv_id").distinct().withColumn("conv", _key("conv_id"))
    numbers = [F.coalesce(F.col(n), F.lit(0)).alias(n) for n in REPORT.names[1:7]]
    return ids.join(told, "conv", "left").select(
        "conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def _report_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(REPORT)
    kinds = [pa.string(), *[pa.int64()] * 6, pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=REPORT.names)
