"""Feature operators: edge rows and golden relations."""

import pytest
from pyspark.sql import functions as F

from itemscope.operators import clean as C
from itemscope.operators import features as FE
from itemscope.plans.context import Tables
from itemscope.roles import MOVIES_SCHEMA

from conftest import SF001


@pytest.fixture(scope="module")
def small(spark):
    movies = spark.createDataFrame([(1, "A (2000)", "X|Y"), (2, "B", "X|X"), (3, "C (1990)", None)], MOVIES_SCHEMA)
    links = spark.createDataFrame([(1, 1, 1)], "movieId bigint, imdbId bigint, tmdbId bigint")
    ratings = spark.createDataFrame([(1, 1, 4.0, 100), (2, 1, 3.0, 200), (1, 2, 2.5, 50)],
                                    "userId bigint, movieId bigint, rating double, timestamp bigint")
    tags = spark.createDataFrame([(1, 1, "Fun", 10), (1, 1, "fun", 20), (2, 1, "É", 30)],
                                 "userId bigint, movieId bigint, tag string, timestamp bigint")
    cat = C.clean_catalog(movies, links)
    return cat, C.clean_interactions(ratings), C.clean_tags(tags), C.item_categories(cat)


def test_feature_frame_edges(small):
    cat, rc, tc, ig = small
    ff = {r.movieId: r for r in FE.feature_frame(cat, rc, tc, ig).collect()}
    assert len(ff) == 3  # unrated item 3 kept
    one = ff[2]  # single rating: std NULL -> 0.0
    assert one.rating_count == 1 and one.rating_std == 0.0 and one.avg_rating == 2.5
    none = ff[3]
    assert none.rating_count == 0 and none.avg_rating == 0.0 and none.rating_span_seconds == 0
    assert none.release_year_filled == 1990.0 and ff[2].release_year_filled == pytest.approx(1995.0)
    assert ff[1].tag_event_count == 3 and ff[1].tag_tokens == ["fun"] and ff[1].unique_tag_count == 1
    assert ff[1].rating_span_seconds == 100 and ff[1].unique_raters == 2
    assert ff[2].genre_count == 2 and ff[3].genre_count == 0


def test_repeated_category(spark, small):
    cat, rc, tc, ig = small
    piv = {r.movieId: r for r in FE.category_pivot(ig, ["X", "Y"]).collect()}
    assert piv[2].genre_X == 2 and piv[1].genre_X == 1 and piv[1].genre_Y == 1
    pairs = FE.item_tokens(tc, cat)
    frame = FE.model_frame(cat, rc, pairs, ig)
    spec = FE.model_spec(ig, pairs, 20, 20)
    mm = {r.movieId: r for r in FE.model_matrix(frame, spec, ig, pairs).collect()}
    assert mm[2]["genre_x"] == 1.0 and mm[3]["genre_x"] == 0.0
    assert mm[1]["tag_000_fun"] == 1.0 and mm[2]["tag_000_fun"] == 0.0
    long = {(x.movieId, x.feature): x.value for x in FE.model_matrix_long(frame, ig, pairs, spec).collect()}
    assert all(mm[i][f] == v for (i, f), v in long.items())
    assert sum(mm[i][f] for i in mm for f in spec.genre_features + spec.tag_features) == len(long) - 6 * len(mm)


def test_model_frame_is_the_feature_frame_without_lists(small):
    cat, rc, tc, ig = small
    wide = {r.movieId: r.asDict() for r in FE.feature_frame(cat, rc, tc, ig).collect()}
    slim = {r.movieId: r.asDict() for r in FE.model_frame(cat, rc, FE.item_tokens(tc, cat), ig).collect()}
    assert slim == {k: {c: v for c, v in x.items() if c not in ("genres_list", "tag_tokens")} for k, x in wide.items()}


def test_tags_of_unknown_items_stay_out(spark, small):
    from itemscope.operators import text as TX
    from itemscope.plans import queries as Q
    cat, rc, tc, ig = small
    stray = spark.createDataFrame([(9, 99, "fun stray", 10), (9, 1, "fun stray", 10)], "userId bigint, movieId bigint, tag string, timestamp bigint")
    t = Tables(spark, SF001)
    t.catalog, t.tags_clean = cat, C.clean_tags(stray)
    weights, vocab = TX.tfidf(Q._text_parts(t), "movieId", "text", 10, 1, all_ids=cat.select("movieId"))
    rows = {r.term: (r.df, r.idf) for r in vocab.collect()}
    assert {r.movieId for r in weights.collect()} <= {1, 2, 3}
    assert rows["stray"][0] == 1 and all(idf >= 1.0 and df <= 3 for df, idf in rows.values())
    assert {r.movieId for r in FE.item_tokens(t.tags_clean, cat).collect()} == {1}


def test_script_median_and_span(spark):
    r = spark.createDataFrame([(1, 1, 1.0, 0), (2, 1, 2.0, 86400), (3, 1, 4.0, 43200), (4, 1, 5.0, 10)],
                              "userId bigint, movieId bigint, rating double, timestamp bigint")
    row = FE.rating_stats_script(r).first()
    assert row.rating_median == 3.0 and row.rating_span_days == 1.0


def test_unique_names():
    assert FE.unique_names(["genre_large", "genre_LARGE", "genre_x"]) == ["genre_large", "genre_LARGE_2", "genre_x"]


def test_golden_relations(spark):
    """Relations the published numbers obey, on the driver's tables."""
    t = Tables(spark, SF001)
    checks = {r.check: r.value for r in FE.sanity_checks(t.feature_frame).collect()}
    movies = t.movies
    sentinel = movies.filter(F.col("genres") == "(no genres listed)").count()
    assert checks["feature rows"] - sentinel == checks["movies with genres"]
    assert checks["movies with ratings"] == t.ratings_clean.select("movieId").distinct().count()
    dist = t.ratings.groupBy("rating").count().agg(F.sum("count")).first()[0]
    assert dist == t.ratings.count()
    assert checks["feature cols"] == 17


def test_item_tokens_group_rows_once(spark):
    words = ["Fun", "fun", "a", "É", "é1x", "two  words", " pad ", "tab\there", "ﬁne", "FINE", "x", "ob\x1cle", "日本", "ok"]
    rows = [(u, item, w, 10 * u + k) for u in (1, 2) for item in (1, 2, 9) for k, w in enumerate(words)]
    tags = C.clean_tags(spark.createDataFrame(rows, "userId bigint, movieId bigint, tag string, timestamp bigint"))
    catalog = spark.createDataFrame([(1,), (1,), (2,), (None,)], "movieId bigint")
    found = FE.item_tokens(tags, catalog)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Sort [" not in plan and plan.count("count(1)") == 2  # one partial and one final aggregate, no sort
    by_tag = FE.tag_token_pairs(tags)
    before = by_tag.groupBy("movieId", "tag_token").agg(F.sum("events").alias("events"), F.min("first_ts"), F.max("last_ts")) \
        .filter("movieId <> 9")
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, map(tuple, before.collect())))
    assert {r.tag_token for r in found.collect()} == {None, "fun", "e1x", "1x", "two words", "pad", "tab here", "fine", "ob le", "ok"} - {"e1x"}
