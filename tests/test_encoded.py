"""Dictionary-encoded matrices: indices, many features, hot items, edge rows."""

from pyspark.sql import functions as F

from itemscope.operators import encoded as EN


def test_vocabulary_and_vectors(spark):
    cells = spark.createDataFrame([(1, "b", 2.0), (1, "a", 1.0), (2, "c", 5.0), (1, "b", 3.0), (3, None, 9.0), (None, "a", 4.0)],
                                  "id bigint, feature string, value double")
    vocab = EN.vocabulary(cells)
    assert sorted(map(tuple, vocab.collect())) == [("a", 0), ("b", 1), ("c", 2)]
    vectors = EN.encoded_vectors(cells, vocab, "id")
    assert {r.id: (r.indices, r["values"]) for r in vectors.collect()} == {1: ([0, 1], [1.0, 5.0]), 2: ([2], [5.0]), None: ([0], [4.0])}
    back = EN.decoded(vectors, vocab, "id")
    assert sorted(map(tuple, back.filter("id IS NOT NULL").collect())) == [(1, 0, "a", 1.0), (1, 1, "b", 5.0), (2, 2, "c", 5.0)]
    none = cells.limit(0)
    assert EN.vocabulary(none).count() == 0 and EN.encoded_vectors(none, EN.vocabulary(none), "id").count() == 0


def test_a_hundred_thousand_features(spark):
    """As many columns as no plan could hold; one item holds a third of all cells."""
    n = 100_000
    cells = spark.range(3 * n).select(F.when(F.col("id") < n, F.lit(-1)).otherwise(F.col("id")).alias("item"),
                                      F.md5((F.col("id") % n).cast("string").cast("binary")).alias("feature"), F.lit(1.0).alias("value"))
    vocab = EN.vocabulary(cells).checkpoint()
    stats = vocab.agg(F.count("*"), F.min("idx"), F.max("idx"), F.count_distinct("idx")).first()
    assert tuple(stats) == (n, 0, n - 1, n)
    ranked = [r.feature for r in vocab.orderBy("idx").select("feature").collect()]
    assert ranked == sorted(ranked)
    vectors = EN.encoded_vectors(cells, vocab, "item")
    assert vectors.filter("item = -1").first().indices == list(range(n))
    assert vectors.count() == 2 * n + 1
