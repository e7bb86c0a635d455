"""Cleaning and profiling operators on edge rows (FIXTURES.md section 3)."""

import pytest
from pyspark.sql import functions as F

from itemscope.operators import aggregates as A
from itemscope.operators import clean as C
from itemscope.operators import profile as PR
from itemscope.roles import MOVIES_SCHEMA, RATINGS_SCHEMA
from itemscope.sources import readers as RD


def test_bad_numbers_and_range(spark):
    raw = spark.createDataFrame(
        [("1", "1", "abc", "5"), ("1", "", "3.0", "5"), ("1", "2", "3.0", None),
         ("1", "3", "0.5", "1"), ("1", "4", "5.0", "1"), ("1", "5", "0.49", "1"), ("1", "6", "5.01", "1"),
         ("1", "7", "NaN", "1"), (" 12 ", "8", "1.5", "1"), ("1.5", "9", "1.0", "1")],
        "userId string, movieId string, rating string, timestamp string")
    out = C.clean_interactions(raw).orderBy("movieId").collect()
    assert [(r.userId, r.movieId, r.rating) for r in out] == [(1, 3, 0.5), (1, 4, 5.0), (12, 8, 1.5)]


def test_duplicate_members(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, None), (None, None)], "a bigint, b bigint")
    assert A.duplicate_members(df, ["a", "b"]).first()[0] == 4
    rows = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "a bigint, t string")
    assert A.duplicate_members(rows).first()[0] == 2
    empty = spark.createDataFrame([], "a bigint")
    assert A.duplicate_members(empty, ["a"]).first()[0] == 0


def test_uniqueness_guard_modes(spark):
    df = spark.createDataFrame([(1, 1), (1, 1)], "userId bigint, movieId bigint")
    assert C.uniqueness_guard(df, ["userId", "movieId"], "r", mode="report") == 2
    with pytest.raises(C.DuplicateKeyError, match="2"):
        C.uniqueness_guard(df, ["userId", "movieId"], "r", mode="raise")


def test_clean_tags_and_bridge(spark):
    tags = spark.createDataFrame([(1, 1, "\tFunny\t", 10), (1, 1, "   ", 11), (1, 2, None, 12), (2, 2, "A  B", 13)],
                                 "userId bigint, movieId bigint, tag string, timestamp bigint")
    out = C.clean_tags(tags).orderBy("timestamp").collect()
    assert [(r.tag, r.tag_normalized) for r in out] == [("Funny", "funny"), ("A  B", "a  b")]
    movies = spark.createDataFrame([(1, "A (1999)", "X|Y|X"), (2, "B", "(no genres listed)"), (3, "C", "")],
                                   MOVIES_SCHEMA)
    links = spark.createDataFrame([(1, 7, None)], "movieId bigint, imdbId bigint, tmdbId bigint")
    cat = C.clean_catalog(movies, links)
    rows = {r.movieId: r for r in cat.collect()}
    assert rows[1].imdb_title_id == "tt7" and rows[2].imdb_title_id is None
    assert rows[1].release_year == 1999 and rows[2].genres_list is None and rows[3].genres_list == [""]
    bridge = sorted((r.movieId, r.genre) for r in C.item_categories(cat).collect())
    assert bridge == [(1, "X"), (1, "X"), (1, "Y"), (3, "")]


def test_orphans_and_coverage(spark):
    parent = spark.createDataFrame([(1,), (2,)], "movieId bigint")
    child = spark.createDataFrame([(1,), (9,), (9,), (None,)], "movieId bigint")
    assert A.orphan_keys(child, parent, "movieId").count() == 2  # 9 and NULL
    cov = A.coverage(child, parent, "movieId", "x").first()
    assert cov.unmatched_count == 2 and cov.coverage_pct == pytest.approx(100 * (1 - 2 / 3), abs=1e-4)


def test_missing_profile_empty_table(spark):
    empty = spark.createDataFrame([], RATINGS_SCHEMA)
    out = PR.missing_profile({"ratings": empty}).collect()
    assert all(r.null_count == 0 and r.null_pct == 0.0 for r in out) and len(out) == 4


def test_quoted_csv(spark, tmp_path):
    p = tmp_path / "movies.csv"
    p.write_text('movieId,title,genres\n1,"He said ""hi"", bye",Drama\n2,,\n')
    rows = RD.read_csv(spark, str(p), MOVIES_SCHEMA).orderBy("movieId").collect()
    assert rows[0].title == 'He said "hi", bye' and rows[0].genres == "Drama"
    assert rows[1].title is None and rows[1].genres is None


def test_preflight_lists_all(spark, tmp_path):
    with pytest.raises(FileNotFoundError) as e:
        RD.preflight(spark, {"a": str(tmp_path / "a.csv"), "b": str(tmp_path / "b.csv")})
    assert "a:" in str(e.value) and "b:" in str(e.value)


def test_top_categories_ties_are_deterministic(spark):
    movies = spark.createDataFrame([(1, "t", "b|a"), (2, "t", "a|b"), (3, "t", "c")], MOVIES_SCHEMA)
    out = [(r.genres, r.len) for r in PR.top_categories_raw(movies, 2).collect()]
    assert out == [("a", 2), ("b", 2)]


def test_scale_metrics_counts_null_as_a_value(spark):
    from itemscope.operators import profile as PR
    df = spark.createDataFrame([(1, 1, 1.0, 1), (None, 1, 1.0, 1), (2, None, 1.0, 1), (None, None, 1.0, 1)],
                               "userId bigint, movieId bigint, rating double, timestamp bigint")
    row = PR.scale_metrics(df).first()
    assert (row.users, row.items, row.interactions, row.possible_user_item_pairs) == (3, 2, 4, 6)
    assert PR.scale_metrics(df.limit(0)).first().users == 0


def test_nested_lists_are_sorted(spark):
    from itemscope.sources.writers import nest
    df = spark.createDataFrame([(i, i % 3) for i in range(30)], "a int, b int").repartition(7)
    rows = nest(df, "rows", [("b", True), ("a", False)]).first().rows
    assert [(r.b, r.a) for r in rows] == sorted([(i % 3, i) for i in range(30)], key=lambda x: (-x[0], x[1]))
    assert nest(df.limit(0), "rows").first().rows == []
