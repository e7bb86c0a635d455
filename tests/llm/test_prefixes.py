"""The prefix trie against a plain version, with several blocks of columns."""

import hashlib
import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from itemscope.llm import prefixes
from itemscope.llm.queries import QUERIES


def brute(rows):
    told = defaultdict(list)
    for c, n, r, t in rows:
        if c is not None:
            told[c].append(((n is not None, n or 0), r or "", t or ""))
    told = {c: [x[1:] for x in sorted(v, key=lambda x: x[0])] for c, v in told.items()}
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in told}
    built = {c: tuple(told.get(c - c % 5, [])[:h[c]] + v[h[c]:]) for c, v in told.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, v in built.items():
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
        ends[v].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, own in members.items():
        worth = (len(own) - 1) * len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            saved[path[:d]] += worth
            leaves[path[:d]] += children[path] == 0
    return sorted((min(own), len(path), min(members[path[:-1]]) if path else None, len(own), children[path], leaves[path], saved[path],
                   hashlib.sha256(",".join(map(str, sorted(ends[path]))).encode()).hexdigest()) for path, own in members.items())


NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def found(spark, folder, rows, extra=""):
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    if extra:
        df = df.selectExpr("*", *extra.split(";"))
    df.write.mode("overwrite").parquet(f"{folder}/conversations.parquet")
    out = QUERIES["op12_prefix_trie"](spark, str(folder))
    return sorted(tuple(r) for r in out.select(*NAMES).collect())


def key(rows):
    return sorted(rows, key=lambda r: (r[0], r[1]))


def test_shared_and_long_conversations(spark, tmp_path):
    rnd = random.Random(5)
    rows = []
    stem = [(n, "user" if n % 2 else "assistant", f"é{n}") for n in range(60)]
    for c in range(40):
        n = rnd.choice([1, 3, 8, 9, 16, 17, 25, 60])
        own = stem[:n] if c % 3 else stem[:n // 2] + [(x, "user", rnd.choice("ab")) for x in range(n // 2, n)]
        rows += [(c, *t) for t in own]
    rows += [(40 + c, *t) for c in range(30) for t in stem[:33]]  # copies
    assert key(found(spark, tmp_path, rows)) == key(brute(rows))


def test_nulls_gaps_and_clashing_columns(spark, tmp_path):
    rows = [(3, None, None, None), (3, 1, "user", ""), (10, 5, "user", "x"), (10, 2, "", None), (None, 1, "user", "x"), (21, 1, "a", "b"), (-7, 1, "a", "other"),
            (-7, 0, "a", "c" * 5000), (22, 0, "a", "b")]
    got = found(spark, tmp_path, rows, "1 AS block;2 AS level;'x' AS t1;conv_id AS k1;0 AS pos")
    told = [r for r in rows if r[0] is None or r[0] >= 0]
    assert [r for r in got if r[0] >= 0 and r[1] > 0] == [(*r[:2], -7 if r[1] == 1 else r[2], *r[3:]) for r in brute(told) if r[1] > 0]
    root = [r for r in got if r[1] == 0]
    assert len(root) == 1 and root[0][:4] == (-7, 0, None, 5)


def test_empty_table(spark, tmp_path):
    assert found(spark, tmp_path, []) == []


def test_ids_are_joined_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "JOINED_IDS", 3)
    members = spark.range(20).select(F.lit(1).cast("bigint").alias("k1"), F.lit(2).cast("bigint").alias("k2"), F.col("id").alias("conv_id"))
    pieces = prefixes.joined_ids(members).orderBy("first").collect()
    assert ",".join(p.ids for p in pieces) == ",".join(map(str, range(20))) and max(p.ids.count(",") for p in pieces) <= 2
