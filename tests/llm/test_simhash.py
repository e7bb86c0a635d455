"""SimHash: fingerprints and components against a brute-force version, and edge rows."""

import itertools
import random

import xxhash
from pyspark.sql import functions as F

from itemscope.llm import simhash


def brute_fingerprint(text):
    import re
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows):
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, j in itertools.combinations(range(len(rows)), 2):
        if (rows[i][1] ^ rows[j][1]).bit_count() <= 3:
            parent[max(root(i), root(j))] = min(root(i), root(j))
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(i)
    out = {}
    for g in groups.values():
        ids = [rows[i][0] for i in g if rows[i][0] is not None]
        for i in g:
            out[i] = min(ids) if ids else None
    return out


TEXTS = [None, "", " \t\n", "One", "one", "A b", "É b c d", "a b c\x0bd\x0ce", "x " * 9000]


def test_fingerprint_matches_brute_force():
    rng = random.Random(1)
    texts = TEXTS + [" ".join(rng.choice(["ab", "Cd", "éf", "\x00", "z\x85q"]) for _ in range(n)) for n in (1, 2, 3, 4, 50, 400)]
    for t in texts:
        assert simhash.fingerprint(t) == brute_fingerprint(t)


def test_long_texts_in_slices(monkeypatch):
    from itemscope.llm import common
    text = " ".join(f"w{i % 97}" for i in range(5000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "word_windows", lambda d, o: common.word_windows(d, o, 64))
    assert simhash.fingerprint(text) == whole == brute_fingerprint(text)


def _rows(spark, pairs):
    return spark.createDataFrame([(i, f if f < 1 << 63 else f - (1 << 64)) for i, f in pairs], "doc_id bigint, fp bigint")


def test_variants_are_the_balls_without_a_block(spark):
    rng = random.Random(8)
    fps = [0, (1 << 64) - 1] + [rng.getrandbits(64) for _ in range(3)]
    rows = _rows(spark, enumerate(fps)).select("fp", simhash.variants(F.col("fp")).alias("v")).collect()
    low = (1 << 48) - 1
    for r in rows:
        f, want = r.fp & (1 << 64) - 1, set()
        for b in range(4):
            rest = (f >> 16 * (b + 1) | f << 48 - 16 * b) & low if b < 3 else f & low
            want |= {b << 48 | rest ^ flip for flip in [0] + [1 << i for i in range(48)]}
        assert len(r.v) == len(want) == 196 and {x & (1 << 64) - 1 for x in r.v} == want


def test_components_match_all_pairs(spark):
    rng = random.Random(7)
    pairs, base = [], [rng.getrandbits(64) for _ in range(6)]
    for i in range(150):
        f = rng.choice(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 5])):
            f ^= 1 << rng.randrange(64)
        pairs.append((i if i % 17 else None, f))
    pairs += [(900, 0), (901, 0), (None, rng.getrandbits(64)), (3, pairs[3][1])]
    want = brute_components(pairs)
    groups = simhash.near_duplicates(_rows(spark, pairs))
    got = {r.fp & (1 << 64) - 1: r.component_id for r in groups.collect()}
    assert {i: got[f] for i, (_, f) in enumerate(pairs)} == want


def test_chain_of_links(spark):
    f, pairs = 0, []
    for i in range(20):
        pairs.append((100 - i, f))
        for b in range(3):
            f ^= 1 << (3 * i + b)
    groups = simhash.near_duplicates(_rows(spark, pairs)).collect()
    assert {r.component_id for r in groups} == {81}


def test_deduplicate_keeps_one_per_component_and_all_columns(spark):
    long = " ".join(f"w{i}" for i in range(300))
    rows = [(5, long, "a"), (2, long + " tail", "b"), (2, long + " tail", "b"), (9, "other words entirely here", "c"),
            (None, "no id at all in this row", "d"), (7, None, "e"), (8, "", "f")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, fp string")
    got = simhash.deduplicate(df)
    assert got.columns == df.columns
    assert sorted(r.fp for r in got.collect()) == ["b", "c", "d", "e"]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash.deduplicate(df).count() == 0


def test_query_against_brute_force(spark):
    from itemscope.llm.queries import QUERIES
    SF001 = "/root/testdata/sf0.001"
    got = {(r.doc_id): (int(r.fingerprint, 16), r.component_id) for r in QUERIES["op1_simhash"](spark, SF001).collect()}
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    rows = [(d.doc_id, brute_fingerprint(d.text)) for d in docs]
    want = brute_components(rows)
    assert got == {d: (f, want[i]) for i, (d, f) in enumerate(rows)}
