"""Cleaning operators C1-C4 and the uniqueness guard Q13.

Each cleaner is one lazy plan over the raw DataFrame. The reference writes
globally sorted files; here ordering is left to the writer
(``sources.writers.write_table(sort_by=...)``), so no plan pays for a global
sort it does not need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemscope.functions import scalars as X
from itemscope.operators.aggregates import duplicate_members
from itemscope.roles import DEFAULT_ROLES, Roles

# Fixed values of the cleaning rules.
NO_CATEGORY_SENTINEL = "(no genres listed)"
SCORE_MIN, SCORE_MAX = 0.5, 5.0
EXTERNAL_ID_PREFIX = "tt"


class DuplicateKeyError(ValueError):
    pass


def uniqueness_guard(df: DataFrame, keys: list[str], table: str, mode: str = "raise") -> int:
    """Q13: count members of duplicated keys; raise in ``raise`` mode.

    One grouped count (a shuffle on the keys, pre-aggregated map-side), no row
    flag is materialised.
    """
    n = duplicate_members(df, keys).first()[0]
    if n and mode == "raise":
        raise DuplicateKeyError(f"{table} has duplicate ({', '.join(keys)}) values: {n}")
    return int(n)


def uniqueness_report(checks: list[tuple[str, DataFrame, list[str]]]) -> DataFrame:
    """Q13 in report mode: one row per guarded table, never raises."""
    parts = [
        duplicate_members(df, keys).select(
            F.lit(table).alias("table"), F.lit(",".join(keys)).alias("key_columns"),
            F.col("duplicate_members"),
            (F.col("duplicate_members") == 0).alias("unique"))
        for table, df, keys in checks
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def clean_catalog(movies: DataFrame, links: DataFrame, r: Roles = DEFAULT_ROLES,
                  guard: str | None = None) -> DataFrame:
    """Typed catalog + external ids, release year, category list, prefixed id."""
    base = (movies.select(
        X.lenient_long(r.item).alias(r.item),
        X.lenient_string(r.title).alias(r.title),
        X.lenient_string(r.categories).alias(r.categories))
        .filter(X.all_not_null([r.item, r.title])))
    ids = links.select(
        X.lenient_long(r.item).alias(r.item),
        X.lenient_long(r.imdb).alias(r.imdb),
        X.lenient_long(r.tmdb).alias(r.tmdb))
    out = base.join(ids, on=r.item, how="left").withColumns({
        "release_year": X.trailing_year(r.title),
        f"{r.categories}_raw": X.nullify(r.categories, NO_CATEGORY_SENTINEL),
    }).withColumns({
        f"{r.categories}_list": X.split_bar(f"{r.categories}_raw"),
        "imdb_title_id": F.when(F.col(r.imdb).isNotNull(), X.prefixed_id(EXTERNAL_ID_PREFIX, r.imdb)),
    })
    if guard:
        uniqueness_guard(out, [r.item], "catalog", guard)
    return out


def clean_interactions(ratings: DataFrame, r: Roles = DEFAULT_ROLES, lo: float = SCORE_MIN,
                       hi: float = SCORE_MAX, guard: str | None = None) -> DataFrame:
    """Typed, complete, in-range interactions plus an event timestamp."""
    cols = [r.user, r.item, r.score, r.epoch]
    out = (ratings.select(
        X.lenient_long(r.user).alias(r.user),
        X.lenient_long(r.item).alias(r.item),
        X.lenient_double(r.score).alias(r.score),
        X.lenient_long(r.epoch).alias(r.epoch))
        .filter(X.all_not_null(cols))
        .filter(X.in_closed_range(r.score, lo, hi))
        .withColumn("rated_at", X.epoch_to_timestamp(r.epoch)))
    if guard:
        uniqueness_guard(out, [r.user, r.item], "interactions", guard)
    return out


def clean_tags(tags: DataFrame, r: Roles = DEFAULT_ROLES) -> DataFrame:
    """Typed, complete tag events with stripped non-empty text."""
    cols = [r.user, r.item, r.tag, r.epoch]
    return (tags.select(
        X.lenient_long(r.user).alias(r.user),
        X.lenient_long(r.item).alias(r.item),
        X.lenient_string(r.tag).alias(r.tag),
        X.lenient_long(r.epoch).alias(r.epoch))
        .filter(X.all_not_null(cols))
        .filter(X.non_empty_stripped(r.tag))
        .withColumn(r.tag, X.strip_whitespace(r.tag))
        .withColumns({
            f"{r.tag}_normalized": F.lower(F.col(r.tag)),
            "tagged_at": X.epoch_to_timestamp(r.epoch),
        }))


def item_categories(catalog: DataFrame, r: Roles = DEFAULT_ROLES, name: str = "genre") -> DataFrame:
    """C4: item-category bridge, one row per list element, NULLs dropped."""
    return (catalog.select(r.item, F.explode(f"{r.categories}_list").alias(name))
            .filter(F.col(name).isNotNull()))
