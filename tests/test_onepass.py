"""The one-scan profile against the single operators, medians against Spark's, wide PCA against numpy."""

import re

import numpy as np
import pytest
from conftest import SF001
from pyspark.sql import functions as F

from itemscope.operators import aggregates as A
from itemscope.operators import decomposition as DC
from itemscope.operators import features as FE
from itemscope.operators import onepass as OP
from itemscope.operators import profile as PR
from itemscope.plans.context import Tables

RAW = ("ratings", "movies", "tags", "links", "genome_scores", "genome_tags")


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    rows = lambda d: sorted(map(repr, d.select(*sorted(d.columns)).collect()))
    assert rows(a) == rows(b)


def all_same(raw):
    known = OP.facts(raw)
    same(OP.shapes(raw, known), PR.table_shapes(raw))
    same(OP.missing(raw, known), PR.missing_profile(raw))
    same(OP.checks(known), PR.quality_checks(raw))
    same(OP.scale(known), PR.scale_metrics(raw["ratings"]))
    same(OP.distribution(known), PR.score_distribution(raw["ratings"]))
    same(OP.coverage(raw), PR.join_coverage(raw))


def test_equals_the_single_operators(spark):
    t = Tables(spark, SF001)
    all_same({n: t.raw(n) for n in RAW})


def test_nulls_and_repeats(spark):
    raw = {
        "ratings": spark.createDataFrame([(1, 1, 5.5, 1), (1, 1, None, 2), (None, 2, 1.0, None), (2, None, 1.0, 3), (None, None, 0.0, 4)],
                                         "userId bigint, movieId bigint, rating double, timestamp bigint"),
        "movies": spark.createDataFrame([(1, None, "a|b"), (1, "x", None), (None, "y", "c")], "movieId bigint, title string, genres string"),
        "tags": spark.createDataFrame([(1, 1, "a", 1), (1, 1, "a", 1), (2, None, None, None)], "userId bigint, movieId bigint, tag string, timestamp bigint"),
        "links": spark.createDataFrame([(1, None, 2), (1, 3, None)], "movieId bigint, imdbId bigint, tmdbId bigint"),
        "genome_scores": spark.createDataFrame([(1, 1, .5), (1, 1, .5), (9, 2, None)], "movieId bigint, tagId bigint, relevance double"),
        "genome_tags": spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "tagId bigint, tag string"),
    }
    all_same(raw)
    all_same({n: df.limit(0) for n, df in raw.items()} | {"ratings": raw["ratings"]})
    known = OP.facts({n: df.limit(0) for n, df in raw.items()})
    assert {r.value for r in OP.checks(known).collect()} == {0} and OP.checks(known).count() == 13
    assert {(r.rows, r.cols > 0) for r in OP.shapes(raw, known).collect()} == {(0, True)}


def test_a_table_is_scanned_once_for_its_facts(spark):
    t = Tables(spark, SF001)
    questions = OP.asked()
    for name in ("movies", "tags", "links", "genome_scores"):
        plan = OP.table_facts(t.raw(name), name, questions[name])._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"FileScan parquet", plan)) == 1, plan
    narrow = OP.coverage({n: t.raw(n) for n in RAW})._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet", narrow)) <= 6  # ratings reads two files


def test_median_by_counts(spark):
    rows = [(1, 1.0, 1), (1, 4.0, 2), (2, 2.0, 1), (2, 2.0, 5), (2, 3.0, 4), (3, None, 1), (4, 1.0, None), (4, None, 3), (4, 2.5, 3), (4, 3.0, 9), (None, 2.0, 1)]
    df = spark.createDataFrame(rows, "movieId bigint, rating double, timestamp bigint")
    got = FE.rating_stats_script(df)
    assert "median" not in got._jdf.queryExecution().executedPlan().toString().lower().replace("rating_median", "")
    want = df.groupBy("movieId").agg(
        F.count(F.lit(1)).alias("rating_count"), F.avg("rating").alias("rating_mean"), F.stddev_samp("rating").alias("rating_std"),
        F.min("rating").alias("rating_min"), F.max("rating").alias("rating_max"), F.median("rating").alias("rating_median"),
        F.min("timestamp").alias("rating_first_ts"), F.max("timestamp").alias("rating_last_ts"))
    by = lambda d: {r.movieId: tuple(round(v, 9) if isinstance(v, float) else v for v in r[1:9]) for r in d.collect()}
    assert by(got) == by(want)
    assert A.median(df, "rating").first()[0] == 2.0 and A.median(df.limit(0), "rating").first()[0] is None


def test_pca_of_a_long_matrix_matches_numpy(spark):
    rng = np.random.default_rng(4)
    n, p = 90, 200
    x = rng.normal(2, 1, (n, p)) * (rng.random((n, p)) < .3)
    x[:, 7] = 0.0
    x[:, 8] = 1.5
    cells = spark.createDataFrame([(int(i), int(j), float(x[i, j])) for i, j in zip(*np.nonzero(x))], "movieId bigint, col_idx int, value double")
    fit = DC.fit_pca_long(cells, "movieId", p, n)
    std = x.std(axis=0)
    z = (x - x.mean(axis=0)) / np.where(std > 1e-12, std, 1.0)
    want = np.sort(np.linalg.svd(z, compute_uv=False) ** 2 / n)[::-1]
    assert np.allclose(fit.eigenvalues[:len(want)], want, atol=1e-9) and fit.eigenvalues[len(want):].max() == pytest.approx(0, abs=1e-9)


def test_full_rows_are_grouped_once_and_where_they_are(spark):
    rows = spark.createDataFrame([(1, 1, "a", 1), (1, 1, "a", 1), (2, None, None, None), (2, 2, "b", 3)],
                                 "userId bigint, movieId bigint, tag string, timestamp bigint").repartition(4, "movieId")
    found = OP.table_facts(rows, "tags", OP.asked()["tags"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan                       # a row is not sent once more for the counts without a key
    assert plan.count("Exchange hashpartitioning") == 1  # the given one: rows with equal columns are together already
    assert {(r.fact, r.name): r.value for r in found.collect()} == {
        ("rows", None): 4, ("nulls", "userId"): 0, ("nulls", "movieId"): 1, ("nulls", "tag"): 1, ("nulls", "timestamp"): 1,
        ("check", "tags_missing_tag_text"): 1, ("duplicates", "tags_duplicate_full_rows"): 2}
