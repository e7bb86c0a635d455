"""Prefix trie of conversations by ROLLUP over positional turn columns.

A node of the trie is a distinct sequence of first turns, a member a conversation that
starts with it. Turns go by two 64-bit hashes of role and text; the first
``COLUMNS`` of a conversation stand in columns t1..tn, and one Spark SQL ``ROLLUP`` over them
aggregates all prefixes together; ``grouping_id`` says how long a prefix is. A
longer conversation continues in further blocks of columns, each a row of its own
keyed by the node its prior block ends in, so all blocks of all lengths meet in the same aggregate.

Sums over a subtree are a second ROLLUP over the nodes. What lies in later blocks is added to the nodes
blocks hang from beforehand, by pointer doubling over those nodes: after i rounds a node
holds what its block tree has within 2^i blocks, so their number grows with the logarithm of the longest conversation.

Plan: texts are read once for their hashes and never shuffled. Everything after is rows of a few
numbers: turns numbered per conversation, blocks, nodes. Copies and common first
turns meet in map-side partial aggregates; a node's members are never collected. Every step is a table in the shared folder.

Defined results: a null role or text is empty; turns of equal number stand by their hashes,
null numbers first; rows without a conversation id belong to none and are left out; a conversation without turns is a member of the root; an
empty table gives no nodes; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from itemscope.llm.common import join_measured, saved

COLUMNS = 8
#: Ids of one node that are joined before their digest is taken.
JOINED_IDS = 4096


def turns(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, pos, k1, k2, bytes): a conversation's turns numbered from 1; ``bytes`` of the text."""
    r, t = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    narrow = rows.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.xxhash64(r, t).alias("k1"), F.xxhash64(F.lit(1), r, t).alias("k2"),
        F.octet_length(t).cast("bigint").alias("bytes"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "k1", "k2")
    return saved(narrow.select("conv_id", F.row_number().over(order).cast("bigint").alias("pos"), "k1", "k2", "bytes"), "turns")


def rebuilt(told: DataFrame, base: Column, first: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Every conversation begun with the first turns of another: ``first`` (at most ``most``) of those of conversation
    ``base``, then its own after as many. Both are expressions of conv_id.

    Returns the turns and (conv_id, length) of every conversation, those left without turns included."""
    opening = F.collect_list(F.when(F.col("pos") <= most, F.struct("pos", "k1", "k2", "bytes")))
    plans = saved(told.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), opening.alias("opening"))
                  .withColumn("base", base).withColumn("first", first), "plans")
    given = plans.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"), F.col("opening").alias("given"))
    plans = saved(plans.select("conv_id", "n", "base", "first").join(given, "base", "left")
                  .withColumn("given", F.filter("given", lambda t: t["pos"] <= F.col("first")))
                  .withColumn("taken", F.least("first", F.coalesce("n_base", F.lit(0)))), "begun")
    prefix = plans.select("conv_id", F.explode("given").alias("t")).select("conv_id", "t.*")
    own = told.join(plans.select("conv_id", "first", "taken"), "conv_id").filter(F.col("pos") > F.col("first")) \
        .select("conv_id", (F.col("pos") - F.col("first") + F.col("taken")).alias("pos"), "k1", "k2", "bytes")
    return prefix.unionByName(own), plans.select("conv_id", (F.col("taken") + F.greatest(F.col("n") - F.col("first"), F.lit(0))).alias("length"))


def _key(pos: Column, k1: Column, k2: Column) -> list[Column]:
    """A turn's part in its node's key: a node's key is the XOR of its turns' parts."""
    return [F.xxhash64(pos, k1, k2), F.xxhash64(pos, k2, k1, F.lit(7))]


def _path_key(block: Column, upto: Column | None = None) -> list[Column]:
    """XOR of the parts of columns t1..tn (of the first ``upto``)."""
    both = []
    for half in (0, 1):
        x = F.lit(0).cast("bigint")
        for i in range(COLUMNS):
            t = F.col(f"t{i + 1}")
            there = t.isNotNull() if upto is None else F.lit(i) < upto
            x = x.bitwiseXOR(F.when(there, _key(block * COLUMNS + i, t["k1"], t["k2"])[half]).otherwise(F.lit(0)))
        both.append(x)
    return both


def blocks(told: DataFrame, lengths: DataFrame) -> DataFrame:
    """(conv_id, block, p1, p2, t1..tn, length): COLUMNS turns a row; p1, p2 is the key of the node the prior block ends in."""
    at = ((F.col("pos") - 1) / COLUMNS).cast("bigint")
    values = [F.max(F.when((F.col("pos") - 1) % COLUMNS == i, F.col(c))).alias(f"{c}{i + 1}")
              for i in range(COLUMNS) for c in ("k1", "k2", "bytes")]
    wide = told.repartition("conv_id").withColumn("block", at).groupBy("conv_id", "block").agg(*values)
    columns = [F.when(F.col(f"k1{i}").isNotNull(), F.struct(F.col(f"k1{i}").alias("k1"), F.col(f"k2{i}").alias("k2"), F.col(f"bytes{i}").alias("bytes")))
               .alias(f"t{i}") for i in range(1, COLUMNS + 1)]
    rows = wide.select("conv_id", "block", *columns)
    own = _path_key(F.col("block"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({"o1": own[0], "o2": own[1]}).withColumns(
        {"p1": F.coalesce(F.bit_xor("o1").over(before), F.lit(0)), "p2": F.coalesce(F.bit_xor("o2").over(before), F.lit(0))})
    rows = rows.join(lengths, "conv_id").select("conv_id", "block", "p1", "p2", *[f"t{i + 1}" for i in range(COLUMNS)], "length")
    none = {"block": F.lit(0).cast("bigint"), "p1": F.lit(0).cast("bigint"), "p2": F.lit(0).cast("bigint")}
    bare = lengths.filter("length = 0").withColumns(
        none | {f"t{i + 1}": F.lit(None).cast(rows.schema["t1"].dataType) for i in range(COLUMNS)}).select(*rows.columns)
    return saved(rows.unionByName(bare), "blocks")


_T = [f"t{i + 1}" for i in range(COLUMNS)]


def _rollup(rows: DataFrame, values: dict[str, str]) -> DataFrame:
    """``values`` over every prefix of a block's columns: (block, p1, p2, t1..tn, level, ...). Prefixes that
    end in an empty column are none; those of no column are the prior block's node, but for the root."""
    sums = ", ".join(f"{v} AS {k}" for k, v in values.items())
    found = rows.sparkSession.sql(
        f"SELECT block, p1, p2, {', '.join(_T)}, {COLUMNS} - bit_count(grouping_id()) AS level, {sums} "
        f"FROM {{rows}} GROUP BY block, p1, p2, ROLLUP ({', '.join(_T)})", rows=rows)
    last = F.coalesce(*[F.when(F.col("level") == i + 1, F.col(t).isNotNull()) for i, t in enumerate(_T)], F.col("block") == 0)
    return found.filter(last)


def nodes(rows: DataFrame) -> DataFrame:
    """Every node: (k1, k2) its key, (q1, q2) its parent's (null at the root), conv_id the smallest member, depth, n_convs,
    n_children, n_leaves and saved_tokens of its subtree, parent_conv_id."""
    own = _rollup(rows, {"n_convs": "count(*)", "conv_id": "min(conv_id)", "deepest": "max(length)"})
    level = F.col("level")
    last = lambda field: F.coalesce(*[F.when(level == i + 1, F.col(t)[field]) for i, t in enumerate(_T)], F.lit(0))
    key, parent = _path_key(F.col("block"), level), _path_key(F.col("block"), level - 1)
    depth = F.col("block") * COLUMNS + level
    found = own.select(
        "block", "p1", "p2", *_T, "level", "conv_id", "n_convs", depth.alias("depth"),
        ((F.col("n_convs") - 1) * last("bytes")).alias("saved"), (F.col("deepest") == depth).cast("bigint").alias("leaves"),
        F.col("p1").bitwiseXOR(key[0]).alias("k1"), F.col("p2").bitwiseXOR(key[1]).alias("k2"),
        F.when(depth > 0, F.col("p1").bitwiseXOR(parent[0])).alias("q1"), F.when(depth > 0, F.col("p2").bitwiseXOR(parent[1])).alias("q2"))
    found = saved(found, "nodes")
    weighed = found.select("block", "p1", "p2", *_T, "level", "k1", "k2", "saved", "leaves")
    below = _below(found)
    if below is not None:
        weighed = join_measured(weighed, below, ["k1", "k2"], "left", F.lit(48)).withColumns(
            {c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0)) for c in ("saved", "leaves")})
    totals = _rollup(weighed.drop("level"), {"saved_tokens": "sum(saved)", "n_leaves": "sum(leaves)"})
    path = _path_key(F.col("block"), level)
    totals = totals.select(F.col("p1").bitwiseXOR(path[0]).alias("k1"), F.col("p2").bitwiseXOR(path[1]).alias("k2"), "saved_tokens", "n_leaves")
    children = found.filter("q1 is not null").groupBy(F.col("q1").alias("k1"), F.col("q2").alias("k2")).agg(F.count(F.lit(1)).alias("n_children"))
    core = found.select("k1", "k2", "q1", "q2", "conv_id", "depth", "n_convs")
    full = saved(core.join(totals, ["k1", "k2"]).join(children, ["k1", "k2"], "left"), "subtrees")
    above = saved(core.join(children.select("k1", "k2"), ["k1", "k2"], "left_semi").select(
        F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("conv_id").alias("parent_conv_id")), "parents")
    return join_measured(full, above, ["q1", "q2"], "left", F.lit(48)).withColumn("n_children", F.coalesce("n_children", F.lit(0)))


def _below(found: DataFrame) -> DataFrame | None:
    """(k1, k2, more_saved, more_leaves): for the nodes that later blocks hang from, the sums of all those blocks."""
    hang = saved(found.filter("block > 0").groupBy("p1", "p2").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"), F.max("block").alias("block"))
                 .withColumnsRenamed({"p1": "k1", "p2": "k2"}), "hanging")
    deepest = hang.agg(F.max("block")).first()[0]
    if deepest is None:
        return None
    ends = found.filter(F.col("level") == COLUMNS).select("k1", "k2", *[F.when(F.col("block") > 0, F.col(p)).alias(j) for p, j in (("p1", "j1"), ("p2", "j2"))])
    now = saved(hang.drop("block").join(ends, ["k1", "k2"]), "block-tree")
    reach = 1
    while reach < deepest:
        up = now.filter("j1 is not null").groupBy(F.col("j1").alias("k1"), F.col("j2").alias("k2")).agg(
            F.sum("saved").alias("up_saved"), F.sum("leaves").alias("up_leaves"))
        jumps = now.select(F.col("k1").alias("j1"), F.col("k2").alias("j2"), F.col("j1").alias("far1"), F.col("j2").alias("far2"))
        now = saved(now.join(up, ["k1", "k2"], "left").join(jumps, ["j1", "j2"], "left").select(
            "k1", "k2", *[(F.col(c) + F.coalesce(f"up_{c}", F.lit(0))).alias(c) for c in ("saved", "leaves")],
            F.col("far1").alias("j1"), F.col("far2").alias("j2")), "block-tree")
        reach *= 2
    return now.select("k1", "k2", F.col("saved").alias("more_saved"), F.col("leaves").alias("more_leaves"))


def ends(rows: DataFrame) -> DataFrame:
    """(k1, k2, conv_id): the node every conversation ends in."""
    path = _path_key(F.col("block"))
    length = sum((F.col(t).isNotNull().cast("bigint") for t in _T), F.col("block") * COLUMNS)
    return rows.filter(F.col("length") == length).select(
        F.col("p1").bitwiseXOR(path[0]).alias("k1"), F.col("p2").bitwiseXOR(path[1]).alias("k2"), "conv_id")


def joined_ids(members: DataFrame) -> DataFrame:
    """(k1, k2, first, ids): every node's ids in order, joined by commas in pieces. Ids are dealt by range, so a
    node of very many members is joined by several tasks."""

    def run(batches):
        at, first, held = None, None, []
        for b in batches:
            out = []
            for k1, k2, c in zip(*(x.to_pylist() for x in b.columns)):
                if (k1, k2) != at or len(held) >= JOINED_IDS:
                    if at is not None:
                        out.append((*at, first, ",".join(held)))
                    at, first, held = (k1, k2), c, []
                held.append(str(c))
            yield batch_of(out)
        if at is not None:
            yield batch_of([(*at, first, ",".join(held))])

    def batch_of(out):
        return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                                          names=["k1", "k2", "first", "ids"])

    dealt = members.withColumn("conv_id", F.col("conv_id").cast("bigint")).select("k1", "k2", "conv_id")
    return dealt.repartitionByRange("k1", "k2", "conv_id").sortWithinPartitions("k1", "k2", "conv_id") \
        .mapInArrow(run, "k1 bigint, k2 bigint, first bigint, ids string")
