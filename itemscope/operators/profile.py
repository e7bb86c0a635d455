"""Profiling and audit operators Q1-Q13, Q17 over a dict of named tables.

Every result is a DataFrame. Per table there is one aggregate for all
conditional/NULL counts; duplicate checks are grouped counts (partial
aggregation map-side), coverage checks anti joins of distinct keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemscope.functions import scalars as X
from itemscope.operators import aggregates as A
from itemscope.roles import CORE_TABLES, DEFAULT_ROLES, Roles


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def table_shapes(tables: dict[str, DataFrame], core: tuple[str, ...] = CORE_TABLES) -> DataFrame:
    """Q1 without sizes: table, rows, cols, scope (sizes: ``sources.readers.input_sizes``)."""
    return _union([
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table"), F.col("rows"),
            F.lit(len(df.columns)).cast("bigint").alias("cols"),
            F.lit("core" if name in core else "optional").alias("scope"))
        for name, df in tables.items()
    ])


def schema_listing(spark: SparkSession, tables: dict[str, DataFrame], type_col: str = "sample_dtype") -> DataFrame:
    """Q2: table, column, type - from the declared schemas, no data read."""
    rows = [(name, f.name, f.dataType.simpleString()) for name, df in tables.items() for f in df.schema.fields]
    return spark.createDataFrame(rows, f"table string, column string, {type_col} string")


def missing_profile(tables: dict[str, DataFrame], digits: int = 4) -> DataFrame:
    """NULL count and percent of every column, one aggregate per table."""
    return _union([A.missing_long(df, name, digits=digits) for name, df in tables.items()])


def missing_nonzero(tables: dict[str, DataFrame]) -> DataFrame:
    """Q3 subset with at least one NULL."""
    return missing_profile(tables).filter(F.col("null_count") > 0)


def _grouped_checks(df: DataFrame, keys: list[str] | None, dup_name: str | None,
                    named: list[tuple[str, "F.Column"]]) -> DataFrame:
    """One grouped aggregate per table: the duplicate-member count of the key
    plus any conditional row counts (summed over the groups), as (check, value).
    One scan and one shuffle (map-side combined) per table."""
    keys = list(keys or df.columns)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"),
                                    *[F.count_if(cond).alias(f"_c{i}") for i, (_, cond) in enumerate(named)])
    aggs = [F.coalesce(F.sum(F.col(f"_c{i}")), F.lit(0)).cast("bigint").alias(n) for i, (n, _) in enumerate(named)]
    if dup_name:
        aggs.append(F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).cast("bigint").alias(dup_name))
    wide = per_key.agg(*aggs)
    names = [n for n, _ in named] + ([dup_name] if dup_name else [])
    return wide.selectExpr("stack(%d, %s) AS (`check`, value)" % (
        len(names), ", ".join(f"'{n}', `{n}`" for n in names)))


def quality_checks(tables: dict[str, DataFrame], r: Roles = DEFAULT_ROLES,
                   lo: float = 0.5, hi: float = 5.0) -> DataFrame:
    """Q4: the 13 named checks as (check, value), one grouped aggregate per table."""
    parts = [
        _grouped_checks(tables["ratings"], [r.user, r.item], "ratings_duplicate_user_movie_pairs", [
            ("ratings_missing_required", X.any_null([r.user, r.item, r.score, r.epoch])),
            ("ratings_out_of_range", X.outside_range(r.score, lo, hi)),
        ]),
        _grouped_checks(tables["movies"], [r.item], "movies_duplicate_movieId", [
            ("movies_missing_title", F.col(r.title).isNull()),
            ("movies_missing_genres", F.col(r.categories).isNull()),
        ]),
        _grouped_checks(tables["tags"], None, "tags_duplicate_full_rows", [
            ("tags_missing_tag_text", F.col(r.tag).isNull()),
        ]),
        _grouped_checks(tables["links"], [r.item], "links_duplicate_movieId", [
            ("links_missing_imdbId", F.col(r.imdb).isNull()),
            ("links_missing_tmdbId", F.col(r.tmdb).isNull()),
        ]),
        _grouped_checks(tables["genome_scores"], [r.item, r.tag_id], "genome_scores_duplicate_movie_tag", []),
        _grouped_checks(tables["genome_tags"], [r.tag_id], "genome_tags_duplicate_tagId", []),
    ]
    return _union(parts)


def join_coverage(tables: dict[str, DataFrame], r: Roles = DEFAULT_ROLES) -> DataFrame:
    """Q5: unmatched distinct keys and coverage for the four relations."""
    movies, gt = tables["movies"], tables["genome_tags"]
    rel = [
        (tables["ratings"], movies, r.item, "ratings movieId matched in movies"),
        (tables["tags"], movies, r.item, "tags movieId matched in movies"),
        (tables["genome_scores"], movies, r.item, "genome_scores movieId matched in movies"),
        (tables["genome_scores"], gt, r.tag_id, "genome_scores tagId matched in genome_tags"),
    ]
    return _union([A.coverage(child, parent, key, label) for child, parent, key, label in rel])


def scale_metrics(ratings: DataFrame, r: Roles = DEFAULT_ROLES) -> DataFrame:
    """Users, items, interactions, possible pairs, density and sparsity
    (6 digits). NULL counts as one more user or item."""
    has_null = lambda c: F.coalesce(F.max(F.col(c).isNull().cast("int")), F.lit(0))
    g = ratings.agg(
        (F.count_distinct(r.user) + has_null(r.user)).alias("users"),
        (F.count_distinct(r.item) + has_null(r.item)).alias("items"),
        F.count(F.lit(1)).alias("interactions"),
    )
    possible = (F.col("users") * F.col("items")).cast("bigint")
    dens = F.col("interactions") / possible
    return g.select(
        F.col("users").cast("bigint").alias("users"), F.col("items").cast("bigint").alias("items"),
        F.col("interactions").cast("bigint").alias("interactions"),
        possible.alias("possible_user_item_pairs"),
        F.when(possible > 0, F.round(dens * 100, 6)).otherwise(F.lit(0.0)).alias("density_pct"),
        F.when(possible > 0, F.round((F.lit(1.0) - dens) * 100, 6)).otherwise(F.lit(0.0)).alias("sparsity_pct"),
    )


def score_distribution(ratings: DataFrame, r: Roles = DEFAULT_ROLES) -> DataFrame:
    """Q7: rows per score value."""
    return A.group_count(ratings, r.score, "len")


def top_categories_raw(movies: DataFrame, k: int = 15, r: Roles = DEFAULT_ROLES) -> DataFrame:
    """Q8: top-k pieces of the raw bar-separated column, sentinel included."""
    pieces = movies.select(F.explode_outer(X.split_bar(r.categories)).alias(r.categories))
    counts = A.group_count(pieces, r.categories, "len")
    return counts.orderBy(F.desc("len"), F.asc_nulls_last(r.categories)).limit(k)


def data_dictionary(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Q9: schema listing left-joined with the missing profile (NULL -> 0).
    Both sides hold one row per column."""
    schema = schema_listing(spark, tables)
    miss = missing_profile(tables)
    j = schema.join(miss, ["table", "column"], "left")
    return j.select("table", "column", "sample_dtype",
                    F.coalesce("null_count", F.lit(0)).cast("bigint").alias("null_count"),
                    F.coalesce("null_pct", F.lit(0.0)).alias("null_pct"))


def processed_dictionary(tables: dict[str, DataFrame]) -> DataFrame:
    """Q10: dtype, NULL count and percent of the cleaned tables."""
    parts = []
    for name, df in tables.items():
        types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        m = A.missing_long(df, name)
        dtype = F.create_map(*[x for c, t in types.items() for x in (F.lit(c), F.lit(t))])
        parts.append(m.select("table", "column", dtype[F.col("column")].alias("dtype"), "null_count", "null_pct"))
    return _union(parts)


def rows_before_after(raw: dict[str, DataFrame], clean: dict[str, DataFrame]) -> DataFrame:
    """Q11: raw rows, clean rows, rows removed; the links line compares the
    links table with the catalog rows that carry its columns."""
    pairs = [("movies", raw["movies"], clean["catalog"]),
             ("ratings", raw["ratings"], clean["ratings_clean"]),
             ("tags", raw["tags"], clean["tags_clean"]),
             ("links_as_joined_columns", raw["links"], clean["catalog"])]
    parts = []
    spark = raw["movies"].sparkSession
    for name, a, b in pairs:
        ra = a.agg(F.count(F.lit(1))).scalar()
        rb = b.agg(F.count(F.lit(1))).scalar()
        parts.append(spark.range(1).select(F.lit(name).alias("table"), ra.alias("raw_rows"), rb.alias("clean_rows"))
                     .withColumn("rows_removed", F.col("raw_rows") - F.col("clean_rows")))
    return _union(parts)


def orphan_check(clean: dict[str, DataFrame], r: Roles = DEFAULT_ROLES) -> DataFrame:
    """Q12: unmatched item keys of the cleaned interactions and tags."""
    cat = clean["catalog"]
    rel = [("ratings.movieId in movies_clean.movieId", clean["ratings_clean"]),
           ("tags.movieId in movies_clean.movieId", clean["tags_clean"])]
    return _union([
        A.orphan_keys(df, cat, r.item).agg(F.count(F.lit(1)).alias("unmatched_count"))
        .select(F.lit(label).alias("relationship"), F.col("unmatched_count"))
        for label, df in rel
    ])


def event_time_range(df: DataFrame, epoch: str = "timestamp") -> DataFrame:
    """Q17: first and last event as epoch seconds and timestamps."""
    g = df.agg(F.min(epoch).alias("min_ts"), F.max(epoch).alias("max_ts"))
    return g.select("min_ts", "max_ts", X.epoch_to_timestamp("min_ts").alias("min_time"),
                    X.epoch_to_timestamp("max_ts").alias("max_time"))
