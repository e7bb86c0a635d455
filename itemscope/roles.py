"""Column roles and declared schemas.

The caller says which column plays which role; only the runs from files to
files look for the first of several names (``first_available``). The defaults are the names of the reference's
catalog domain, so tables already in that shape need no mapping.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Roles:
    item: str = "movieId"
    user: str = "userId"
    score: str = "rating"
    epoch: str = "timestamp"
    title: str = "title"
    categories: str = "genres"
    tag: str = "tag"
    tag_id: str = "tagId"
    relevance: str = "relevance"
    imdb: str = "imdbId"
    tmdb: str = "tmdbId"


DEFAULT_ROLES = Roles()

# Raw input schemas (declared, never inferred).
MOVIES_SCHEMA = T.StructType([
    T.StructField("movieId", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("genres", T.StringType()),
])
RATINGS_SCHEMA = T.StructType([
    T.StructField("userId", T.LongType()),
    T.StructField("movieId", T.LongType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
])
TAGS_SCHEMA = T.StructType([
    T.StructField("userId", T.LongType()),
    T.StructField("movieId", T.LongType()),
    T.StructField("tag", T.StringType()),
    T.StructField("timestamp", T.LongType()),
])
LINKS_SCHEMA = T.StructType([
    T.StructField("movieId", T.LongType()),
    T.StructField("imdbId", T.LongType()),
    T.StructField("tmdbId", T.LongType()),
])
GENOME_SCORES_SCHEMA = T.StructType([
    T.StructField("movieId", T.LongType()),
    T.StructField("tagId", T.LongType()),
    T.StructField("relevance", T.DoubleType()),
])
GENOME_TAGS_SCHEMA = T.StructType([
    T.StructField("tagId", T.LongType()),
    T.StructField("tag", T.StringType()),
])

RAW_SCHEMAS = {
    "movies": MOVIES_SCHEMA,
    "ratings": RATINGS_SCHEMA,
    "tags": TAGS_SCHEMA,
    "links": LINKS_SCHEMA,
    "genome_scores": GENOME_SCORES_SCHEMA,
    "genome_tags": GENOME_TAGS_SCHEMA,
}

CORE_TABLES = ("movies", "ratings", "tags", "links")
OPTIONAL_TABLES = ("genome_scores", "genome_tags")
ALL_TABLES = CORE_TABLES + OPTIONAL_TABLES


def first_available(df, names: list[str]) -> str | None:
    """The first of ``names`` that is a column of ``df`` (its schema is looked at, no data)."""
    return next((n for n in names if n in df.columns), None)
