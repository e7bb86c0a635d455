"""Decontamination against a brute-force version, and edge rows."""

import random

from brute import contamination
from itemscope.llm import common, winnowing
from itemscope.llm.common import text_key


def _check(spark, docs, items):
    d = spark.createDataFrame([(i, t) for i, t in enumerate(docs)], "doc_id bigint, text string")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    found = winnowing.contamination(d, b)
    got = {r.doc_id: (r.n_hit, set(r["items"])) for r in d.select("doc_id", *text_key("text")).join(found, ["k1", "k2"]).collect()}
    for i, t in enumerate(docs):
        n, keys = contamination(t, items)
        assert got.get(i, (0, set())) == (n, {"" if k is None else str(k) for k in keys}), (i, t)
    return got


def test_random_overlaps(spark):
    rng = random.Random(11)
    word = lambda: rng.choice("ab cd ef gh ij kl é9 mn2 op".split())
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 2, 4, 9, 10, 11, 14, 30])))) for i in range(25)]
    items += [(100, items[3][1]), (101, items[20][1].upper()), (102, None), (103, " .;- "), (104, "")]
    docs = [None, "", " !", "ab"]
    for _ in range(80):
        words = [rng.choice(["zz", "yy", "xx"]) + str(rng.randrange(50)) for _ in range(rng.randint(1, 60))]
        for _ in range(rng.randint(0, 3)):
            w = rng.choice(items[:25])[1].split()
            a = rng.randrange(len(w))
            at = rng.randrange(len(words) + 1)
            words[at:at] = w[a:a + rng.randint(1, 20)]
        docs.append(rng.choice([" ", "-", ", "]).join(words))
    docs += docs[-3:]
    assert len(_check(spark, docs, items)) > 20


def test_only_long_items(spark):
    items = [(1, " ".join(f"w{i}" for i in range(30)))]
    docs = [" ".join(f"w{i}" for i in range(a, b)) for a, b in ((0, 9), (0, 10), (5, 16), (20, 30), (21, 30))] + ["x " * 50]
    assert set(_check(spark, docs, items)) == {1, 2, 3}


def test_texts_in_slices(monkeypatch):
    text = " ".join(f"w{i % 37}" for i in range(900))
    whole = [h for _, h in winnowing._words(text, 9)][0]
    monkeypatch.setattr(winnowing, "word_windows", lambda d, o: common.word_windows(d, o, 100))
    parts = list(winnowing._words(text, 9))
    assert len(parts) > 3
    for at, h in parts:
        assert (whole[at:at + len(h)] == h).all()
    assert parts[-1][0] + len(parts[-1][1]) == 900


def test_every_run_of_a_window_keeps_a_gram():
    import numpy as np
    rng = np.random.default_rng(5)
    for n in (6, 7, 40, 300):
        grams = rng.integers(0, 5, n).astype(np.uint64)
        kept = set(winnowing._kept(grams, 6).tolist())
        assert all(kept & set(range(i, i + 6)) for i in range(n - 5))


def test_empty_tables_and_columns(spark):
    d = spark.createDataFrame([(1, "a b c", 7), (2, "x", 8), (2, "x", 8), (None, None, 9)], "doc_id bigint, text string, hits int")
    b = spark.createDataFrame([], "item_id bigint, text string")
    got = winnowing.decontaminate(d, b)
    assert got.columns == d.columns and got.count() == 4
    one = spark.createDataFrame([(5, "A-B")], "item_id bigint, text string")
    assert sorted(r.hits for r in winnowing.decontaminate(d, one).collect()) == [8, 8, 9]
    assert winnowing.decontaminate(d.limit(0), one).count() == 0
