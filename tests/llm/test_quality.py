"""Rule ledger: measurements against plain Python, policies and ablations, edge rows."""

import random

from pyspark.sql import functions as F

from brute import failures, measures
from itemscope.llm import quality

TEXTS = [None, "", " \n\t", "one", "a b c d e f g h i j", "w " * 4000, "a b c d e a b c d e a b c d e", "x\n\nx\n x\nx", "é" * 40 + " ß",
         "# $ % & | < > * a b c d", "LOUD WORDS ARE ALL OVER THIS LINE HERE NOW OK", "a\x0bb\x0cc\rd e f g h i j k", "\x00 \x1f z", "日本 語 " * 9]


def test_measures_and_bits(spark):
    rng = random.Random(3)
    texts = TEXTS + [" ".join(rng.choice(["a", "B", "c\n", "d#", "ee"]) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    for r in quality.ledger(df).collect():
        m = measures(texts[r.doc_id])
        assert {k: r[k] for k in m} == m, texts[r.doc_id]
        assert r.failures == failures(m)


def test_policies_and_ablation(spark):
    entries = spark.createDataFrame([(0,), (1,), (3,), (4,), (64,), (0,), (2,)], "failures int")
    assert entries.filter(quality.passes(quality.BASE)).count() == 4
    assert entries.filter(quality.passes(quality.FULL)).count() == 2
    got = {r.rule: (r.failed, r.only_this, r.kept) for r in quality.ablation(entries, quality.BASE).collect()}
    assert got == {"few_words": (2, 1, 4), "repeated_windows": (2, 1, 4)}


def test_keep_all_columns_and_empty_table(spark):
    good = "these are quite a few plain words in one plain line"
    df = spark.createDataFrame([(1, good, 5), (None, good, 6), (1, good, 5), (2, "few", 7), (3, None, 8)], "doc_id bigint, text string, n_words int")
    got = quality.keep(df)
    assert got.columns == df.columns and sorted(r.n_words for r in got.collect()) == [5, 5, 6]
    assert quality.keep(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")
    plan = quality.ledger(df.withColumn("text", F.col("text")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
