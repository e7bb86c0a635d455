"""Conversation structure repair by a rank-convergence parallel Viterbi.

A conversation's roles should read ``(s?(ua)+)?`` by their initials (system, user,
assistant). The cheapest edits that make it so are a shortest path over four states (nothing
said yet, after system, after user, after assistant). Costs run backwards: a vector of four
costs-to-go passes over the rows from the last to the first, and the path is traced
forwards along it, always by the least initial that stays on a cheapest path.

A long conversation is cut into chunks that work in parallel:

1. every chunk runs from a speculative cost vector (the last from the true one);
2. fix-up passes give a chunk the vector its right neighbour really ends with; it reruns
   only until its vectors differ from those of the run before by a constant, which is
   nearly always after a few rows. A pass walks stretches of neighbouring chunks, and stretches grow by
   ``STRETCH`` from pass to pass, so rows that never make vectors converge (a long run of
   rows that must go) take a logarithmic number of passes too;
3. with the stitched vectors every chunk traces from all four states at once; a stream over the
   chunks' (start -> end) maps tells each chunk its state, and it writes its edits.

Vectors count up to a constant only and take few values, so a row costs a dictionary look-up.

Plan: rows are sorted by (conversation, turn) through a range partitioning, which splits a
conversation of any size over tasks (only rows of one turn stay together), and stored as
chunks of at most ``CHUNK_ROWS`` rows or about ``CHUNK_BYTES``; the passes read the chunks' symbols, one byte a row.
Only the last pass reads texts again. Repeats are found by an aggregate over hashes.

Edits: Keep 0, Rerole to user or assistant 3, Delete 4, Insert an empty user or assistant
row 3; a row that is not deleted although cut off costs 3 more; blank rows and repeats must be deleted.

Defined results: null role or text counts as one space; rows without a conversation id form one
conversation; rows of equal turn stand by role, then text, null turns first; equal rows are repeats;
roles count by their first character, another one than s, u or a (or none) must be reroled or deleted;
an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itemscope.llm.common import SPACES, join_measured, saved, text_key

CHUNK_ROWS = 64
CHUNK_BYTES = 1 << 20
#: Chunks (then stretches) that one stretch of the next fix-up pass joins.
STRETCH = 32

REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
#: States: nothing said, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: What a user or assistant row leads to; the role that a state asks for.
NEXT = (USER, USER, ASSISTANT, USER)
WANTED = ("user", "user", "assistant", "user")
#: Cost to the end of a conversation, and a first guess inside it.
END, GUESS = bytes((0, 2 * INSERT, INSERT, 0)), bytes(4)
FINE, CUT, GOES = range(3)
_KEEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
_INITIALS = "sua"


def symbol(initial: str, fault: int) -> int:
    """A row as a number below 12: its initial's class and what is wrong with it."""
    return 3 * (_INITIALS.find(initial) if initial else -1) % 12 + fault


class Steps:
    """Steps over one row, remembered by (symbol, normal cost vector)."""

    def __init__(self):
        self.back: dict[tuple[int, bytes], tuple[bytes, int]] = {}
        self.traced: dict[tuple[int, bytes, int], tuple[str, int, int]] = {}

    def _moves(self, sym: int, after: bytes, state: int) -> Iterator[tuple[str, int, int]]:
        """(initial, cost of all to come, next state) of the edits that take up the row."""
        kind, fault = divmod(sym, 3)
        yield "D", DELETE + after[state], state
        if fault != GOES:
            more = CUT_OFF if fault == CUT else 0
            initial = _INITIALS[kind:kind + 1]
            if (state, initial) in _KEEPS:
                to = _KEEPS[state, initial]
                yield "K", more + after[to], to
            if initial != WANTED[state][0]:
                yield "R", REROLE + more + after[NEXT[state]], NEXT[state]

    def _costs(self, sym: int, after: bytes) -> list[int]:
        plain = [min(m[1] for m in self._moves(sym, after, s)) for s in range(4)]
        return [min(plain[s], INSERT + plain[NEXT[s]], 2 * INSERT + plain[NEXT[NEXT[s]]]) for s in range(4)]

    def before(self, sym: int, after: bytes) -> tuple[bytes, int]:
        """The cost vector in front of a row, less its least entry, and that entry."""
        got = self.back.get((sym, after))
        if got is None:
            costs = self._costs(sym, after)
            low = min(costs)
            got = self.back[sym, after] = bytes(c - low for c in costs), low
        return got

    def trace(self, sym: int, after: bytes, state: int) -> tuple[str, int, int]:
        """(initials, next state, cost) of the least cheapest edits up to and with a row."""
        got = self.traced.get((sym, after, state))
        if got is None:
            costs, edits, spent, at = self._costs(sym, after), "", 0, state
            while True:
                ways = [(e, to, c - after[to]) for e, c, to in self._moves(sym, after, at) if c == costs[at]]
                if INSERT + costs[NEXT[at]] == costs[at]:
                    ways.append(("I", NEXT[at], INSERT))
                edit, at, cost = min(ways)
                edits, spent = edits + edit, spent + cost
                if edit != "I":
                    break
            got = self.traced[sym, after, state] = edits, at, spent
        return got

    def run(self, symbols: bytes, vector: bytes) -> bytes:
        """The vector at a chunk's start from the one at its end."""
        for sym in reversed(symbols):
            vector = self.before(sym, vector)[0]
        return vector

    def rerun(self, symbols: bytes, old: bytes, new: bytes, result: bytes) -> bytes:
        """The same for another vector at the end; it stops where both runs differ by a constant."""
        for sym in reversed(symbols):
            if old == new:
                return result
            old, new = self.before(sym, old)[0], self.before(sym, new)[0]
        return new

    def edits(self, symbols: bytes, vector: bytes, state: int, last: bool) -> tuple[str, int, int]:
        """(initials, end state, cost) of a chunk entered in ``state``; a last chunk also closes the conversation."""
        afters = [vector]
        for sym in reversed(symbols[1:]):
            afters.append(self.before(sym, afters[-1])[0])
        parts, spent = [], 0
        for sym, after in zip(symbols, reversed(afters)):
            edits, state, cost = self.trace(sym, after, state)
            parts.append(edits)
            spent += cost
        while last and state in (SYSTEM, USER):
            parts.append("I")
            spent += INSERT
            state = NEXT[state]
        return "".join(parts), state, spent


def damaged(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, dropped): rows damaged by a checksum of conversation and turn;
    a dropped row stays as a mark of its conversation."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(word(conv_id), F.lit(":"), word(turn)).cast("binary")) % 20
    marked = rows.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), word(role).alias("role"), word(text).alias("text"),
                         kind.alias("kind"))
    told = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return marked.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), told.alias("text"),
                         (F.col("kind") == 0).alias("dropped"), F.explode(times).alias("copy")).drop("copy")


def _order(c: str) -> Column:
    """A struct that sorts like ``c`` with nulls first."""
    return F.struct(F.col(c).isNotNull().alias("known"), F.col(c).alias("turn"))


_COUNTS = ["n_turns", "blank", "duplicate", "truncated", "illegal"]


def chunks(rows: DataFrame) -> DataFrame:
    """The sorted rows (conv_id, turn, role, text, dropped) as chunks of one conversation each: symbols, roles and texts,
    counts, lowest and highest turn, first and last initials. Chunks order by (first turn, cid)."""
    keyed = rows.withColumns(dict(zip(("k1", "k2"), text_key(F.concat_ws("\x00", F.col("conv_id").cast("string"), "role", "text")))))
    spread = keyed.filter("not dropped").groupBy("k1", "k2").agg(F.min(_order("turn")).alias("first"), F.max(_order("turn")).alias("last"))
    again = saved(spread.filter("first <> last").select("k1", "k2", F.col("first").alias("first")), "repeats")
    plain = F.rtrim(F.col("text"), F.lit(SPACES))
    fault = F.when(plain == "", F.lit(GOES)).when(F.substring(plain, -1, 1).isin(".", "!", "?"), F.lit(FINE)).otherwise(F.lit(CUT))
    told = join_measured(keyed, again, ["k1", "k2"], "left", F.lit(64)).select(
        "conv_id", "turn", "role", "text", "dropped", fault.alias("fault"), (plain == "").alias("blank"),
        F.coalesce(_order("turn") > F.col("first"), F.lit(False)).alias("later"))
    dealt = told.repartitionByRange("conv_id", F.col("turn").asc_nulls_first()) \
        .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    types = {f.name: f.dataType for f in rows.schema.fields}
    schema = T.StructType([
        T.StructField("conv_id", types["conv_id"]), T.StructField("first_turn", types["turn"]), T.StructField("cid", T.LongType()),
        T.StructField("symbols", T.BinaryType()), T.StructField("roles", T.ArrayType(T.StringType())), T.StructField("texts", T.ArrayType(T.StringType())),
        T.StructField("low", types["turn"]), T.StructField("high", types["turn"]), T.StructField("head", T.StringType()), T.StructField("tail", T.StringType()),
        *[T.StructField(c, T.LongType()) for c in _COUNTS]])
    rows_limit, bytes_limit = CHUNK_ROWS, CHUNK_BYTES

    def run(batches):
        context = TaskContext.get()
        cid = (context.partitionId() if context else 0) << 33
        arrow = None
        held: list | None = None     # the chunk being filled, in the order of the schema
        size, before = 0, None       # its bytes; the row before, if of the same conversation
        turn_before = last = None

        def flush(done):
            return pa.RecordBatch.from_arrays([pa.array(column, f.type) for column, f in zip(zip(*done), arrow)], schema=arrow)

        for batch in batches:
            if arrow is None:
                types = [batch.schema.field(0).type, batch.schema.field(1).type]
                arrow = pa.schema([("conv_id", types[0]), ("first_turn", types[1]), ("cid", pa.int64()), ("symbols", pa.binary()),
                                   ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("low", types[1]), ("high", types[1]),
                                   ("head", pa.string()), ("tail", pa.string()), *[(c, pa.int64()) for c in _COUNTS]])
            done = []
            for conv, turn, role, text, dropped, fault, blank, later in zip(*(c.to_pylist() for c in batch.columns)):
                new = last is None or last[0] != conv
                if held is None or new or len(held[3]) >= rows_limit or size >= bytes_limit:
                    if held is not None:
                        held[3] = bytes(held[3])
                        done.append(held)
                        cid += 1
                    held, size = [conv, turn, cid, bytearray(), [], [], None, None, None, None, 0, 0, 0, 0, 0], 0
                if new:
                    last, before, turn_before = (conv,), None, None
                if dropped:
                    continue
                initial = role[:1]
                if turn is not None and turn != turn_before:
                    held[10] += 1
                    held[6] = turn if held[6] is None else held[6]
                    held[7] = turn_before = turn
                if blank:
                    held[11] += 1
                elif later or before == (turn, role, text):
                    held[12] += 1
                    fault = GOES
                elif fault == CUT:
                    held[13] += 1
                if held[8] is None:
                    held[8] = initial
                else:
                    held[14] += held[9] + initial not in ("su", "ua", "au")
                held[9] = initial
                before = (turn, role, text)
                held[3].append(symbol(initial, fault))
                held[4].append(role)
                held[5].append(text)
                size += len(text)
            if done:
                yield flush(done)
        if held is not None:
            held[3] = bytes(held[3])
            yield flush([held])

    return saved(dealt.mapInArrow(run, schema), "chunks")


def _vectors(symbols: pa.Array, ends: list[bytes]) -> list[bytes]:
    steps = Steps()
    return [steps.run(s, v) for s, v in zip(symbols.to_pylist(), ends)]


def stitched(parts: DataFrame) -> DataFrame:
    """(cid, vector, state, n): of every chunk of ``parts`` (conv, cid, place, symbols; place 0 is a
    conversation's last chunk) the true vector at its end and the state it is entered in."""

    def guess(batches):
        for b in batches:
            ends = [END if p == 0 else GUESS for p in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ends, pa.binary()), pa.array(_vectors(b.column(3), ends), pa.binary())],
                                             names=["conv", "cid", "place", "symbols", "vector", "out"])

    schema = "conv bigint, cid bigint, place bigint, symbols binary, vector binary, out binary"
    now = saved(parts.select("conv", "cid", "place", "symbols").mapInArrow(guess, schema), "vectors")
    span = 1
    by_conv = Window.partitionBy("conv").orderBy("place")
    while True:
        seen = saved(now.withColumn("right", F.coalesce(F.lag("out").over(by_conv), F.lit(END))), "fix-up")
        if seen.filter("right <> vector").isEmpty():
            break
        span *= STRETCH
        now = saved(_fixed_up(seen, span), "vectors")

    def maps(batches):
        steps = Steps()
        for b in batches:
            ends = [bytes(steps.edits(s, v, state, False)[1] for state in range(4))
                    for s, v in zip(b.column("symbols").to_pylist(), b.column("vector").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("conv"), b.column("cid"), b.column("place"), b.column("vector"), pa.array(ends, pa.binary())],
                                             names=["conv", "cid", "place", "vector", "ends"])

    def states(batches):
        conv = state = None
        for b in batches:
            out = []
            for c, ends in zip(b.column("conv").to_pylist(), b.column("ends").to_pylist()):
                if c != conv:
                    conv, state = c, START
                out.append(state)
                state = ends[state]
            yield pa.RecordBatch.from_arrays([b.column("cid"), b.column("place"), b.column("vector"), pa.array(out, pa.int32())],
                                             names=["cid", "place", "vector", "state"])

    mapped = now.mapInArrow(maps, "conv bigint, cid bigint, place bigint, vector binary, ends binary")
    forward = mapped.repartition("conv").sortWithinPartitions("conv", F.desc("place"))
    return saved(forward.mapInArrow(states, "cid bigint, place bigint, vector binary, state int"), "states")


def _fixed_up(seen: DataFrame, span: int) -> DataFrame:
    """One fix-up pass: stretches of ``span`` chunks are walked from right to left, the first of a
    stretch starts from its right neighbour's vector of the pass before."""

    def run(batches):
        steps, at, carry = Steps(), None, b""
        for b in batches:
            vectors, outs = [], []
            for conv, stretch, symbols, old, out, right in zip(*(b.column(c).to_pylist() for c in ("conv", "stretch", "symbols", "vector", "out", "right"))):
                if (conv, stretch) != at:
                    at, carry = (conv, stretch), right
                vectors.append(carry)
                carry = steps.rerun(symbols, old, carry, out)
                outs.append(carry)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("conv", "cid", "place", "symbols")), pa.array(vectors, pa.binary()), pa.array(outs, pa.binary())],
                                             names=["conv", "cid", "place", "symbols", "vector", "out"])

    dealt = seen.withColumn("stretch", F.floor(F.col("place") / span)).repartition("conv", "stretch").sortWithinPartitions("conv", "stretch", "place")
    return dealt.mapInArrow(run, "conv bigint, cid bigint, place bigint, symbols binary, vector binary, out binary")


def _written(told: DataFrame, conv_id: T.DataType, turn: T.DataType) -> DataFrame:
    """The edits of chunks whose vector and state are known."""
    schema = T.StructType([T.StructField("conv_id", conv_id), T.StructField("conv", T.LongType()), T.StructField("place", T.LongType()),
                           T.StructField("low", turn), T.StructField("high", turn), T.StructField("head", T.StringType()), T.StructField("tail", T.StringType()),
                           *[T.StructField(c, T.LongType()) for c in _COUNTS], T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType()),
                           T.StructField("roles", T.ArrayType(T.StringType())), T.StructField("texts", T.ArrayType(T.StringType()))])
    passed = ["conv_id", "conv", "place", "low", "high", "head", "tail", *_COUNTS]

    def run(batches):
        steps = Steps()
        for b in batches:
            costs, audits, all_roles, all_texts = [], [], [], []
            for symbols, vector, state, place, roles, texts in zip(*(b.column(c).to_pylist() for c in ("symbols", "vector", "state", "place", "roles", "texts"))):
                audit, _, cost = steps.edits(symbols, vector, state, place == 0)
                out_roles, out_texts, row = [], [], 0
                for edit in audit:
                    if edit == "K":
                        out_roles.append(roles[row])
                        state = _KEEPS[state, roles[row][:1]]
                    elif edit != "D":
                        out_roles.append(WANTED[state])
                        state = NEXT[state]
                    if edit != "D":
                        out_texts.append("" if edit == "I" else texts[row])
                    row += edit != "I"
                costs.append(cost)
                audits.append(audit)
                all_roles.append(out_roles)
                all_texts.append(out_texts)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in passed), pa.array(costs, pa.int64()), pa.array(audits, pa.string()),
                 pa.array(all_roles, pa.list_(pa.string())), pa.array(all_texts, pa.list_(pa.string()))],
                names=[*passed, "cost", "audit", "roles", "texts"])

    return told.select(*passed, "symbols", "vector", "state", "roles", "texts").mapInArrow(run, schema)


@dataclass
class Repaired:
    """Edited chunks (audit, cost, roles and texts after the edits, counts before them). ``whole``
    holds conversations of one chunk; ``parts`` the chunks of longer ones, place 0 being the last."""

    whole: DataFrame
    parts: DataFrame


def repair(rows: DataFrame) -> Repaired:
    """Repairs conversations given as (conv_id, turn, role, text, dropped) rows."""
    table = chunks(rows)
    conv = F.coalesce(F.xxhash64("conv_id"), F.lit(0))
    by_conv = Window.partitionBy("conv", "conv_id")
    placed = table.select(conv.alias("conv"), "conv_id", "cid", "symbols", _order("first_turn").alias("at")) \
        .withColumn("n", F.count(F.lit(1)).over(by_conv)).filter("n > 1") \
        .withColumn("place", F.row_number().over(by_conv.orderBy(F.desc("at"), F.desc("cid"))).cast("bigint") - 1)
    # a conversation goes by its first chunk's number from here on, so hashes need not be distinct
    named = saved(placed.select(F.min("cid").over(by_conv).alias("conv"), "cid", "place", "symbols"), "long-conversations")
    where = saved(stitched(named).join(named.select("cid", "conv"), "cid"), "stitched")
    types = {f.name: f.dataType for f in rows.schema.fields}
    ends = where.select("cid")
    one = join_measured(table, ends, ["cid"], "left_anti", F.lit(24)).withColumns(
        {"conv": F.col("cid"), "place": F.lit(0).cast("bigint"), "vector": F.lit(END), "state": F.lit(START)})
    many = join_measured(table, where, ["cid"], "inner", F.lit(64))
    kinds = types["conv_id"], types["turn"]
    return Repaired(_written(one, *kinds), _written(many, *kinds))
