"""Per-item features F1-F12 (and the aggregates A2-A5, A7, A12 they use).

Shape of every plan: aggregate each source by item first (partial + final,
shuffle on the item key), then left-join the per-item results onto a spine.
All per-item sides share the item hash partitioning, so the join chain adds
no shuffle of its own; AQE may still turn a small side into a broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from itemscope.functions import scalars as X
from itemscope.operators import aggregates as A
from itemscope.roles import DEFAULT_ROLES, Roles

FEATURE_FRAME_COLUMNS = [
    "movieId", "title", "release_year", "release_year_filled", "genres_list", "genre_count",
    "tag_tokens", "imdbId", "tmdbId", "rating_count", "avg_rating", "rating_std", "unique_raters",
    "rating_span_seconds", "tag_event_count", "unique_tag_count", "tag_span_seconds",
]

# The six numeric model features, in order.
NUMERIC_MODEL_FEATURES = [
    "release_year_z", "avg_rating_z", "rating_std", "rating_count_log",
    "unique_tag_count_log", "genre_count_log",
]


def unique_names(names: list[str]) -> list[str]:
    """Spark resolves column names case-insensitively: the n-th name equal to an
    earlier one (ignoring case) gets the suffix ``_n``."""
    seen: dict[str, int] = {}
    out = []
    for n in names:
        k = n.lower()
        seen[k] = seen.get(k, 0) + 1
        out.append(n if seen[k] == 1 else f"{n}_{seen[k]}")
    return out


# --- per-item aggregates --------------------------------------------------

def rating_stats(ratings: DataFrame, r: Roles = DEFAULT_ROLES) -> DataFrame:
    """A3: count, mean, sample std, min, max, distinct raters, first/last time.

    Spark plans the single distinct count as a two-level aggregate: first by
    (item, user) - which spreads a hot item over its users - then by item.
    """
    return ratings.groupBy(r.item).agg(
        F.count(F.lit(1)).alias("rating_count"),
        F.avg(r.score).alias("avg_rating"),
        F.stddev_samp(r.score).alias("rating_std"),
        F.min(r.score).alias("min_rating"),
        F.max(r.score).alias("max_rating"),
        F.count_distinct(r.user).alias("unique_raters"),
        F.min(r.epoch).alias("first_rating_ts"),
        F.max(r.epoch).alias("last_rating_ts"),
    )


def rating_stats_script(ratings: DataFrame, r: Roles = DEFAULT_ROLES) -> DataFrame:
    """A2 + X12 (F2): count, mean, std, min, max, exact median, first/last, span in days.

    Rows are counted per (item, score) first, which spreads a hot item and leaves the distinct
    scores of an item; the median is the value (or the mean of the two) whose range of ranks
    holds the middle, so no object aggregate is needed.
    """
    per_score = ratings.groupBy(r.item, r.score).agg(
        F.count(F.lit(1)).alias("_c"), F.min(r.epoch).alias("_t0"), F.max(r.epoch).alias("_t1"))
    own = Window.partitionBy(r.item)
    scored = F.when(F.col(r.score).isNotNull(), F.col("_c")).otherwise(F.lit(0))
    ranked = A.with_middle(per_score.withColumn("_k", scored), [r.item], r.score, "_k") \
        .withColumn("_mean", F.sum(F.col("_k") * F.col(r.score)).over(own) / F.nullif(F.col("_total"), F.lit(0)))
    spread = F.sum(F.col("_k") * (F.col(r.score) - F.col("_mean")) * (F.col(r.score) - F.col("_mean")))
    n = F.max("_total")
    return ranked.groupBy(r.item).agg(
        F.sum("_c").cast("bigint").alias("rating_count"),
        F.max("_mean").alias("rating_mean"),
        F.when(n > 1, F.sqrt(spread / (n - 1))).alias("rating_std"),
        F.min(r.score).alias("rating_min"),
        F.max(r.score).alias("rating_max"),
        (F.sum("_middle") / 2).alias("rating_median"),
        F.min("_t0").alias("rating_first_ts"),
        F.max("_t1").alias("rating_last_ts"),
    ).withColumn("rating_span_days", X.span_days("rating_first_ts", "rating_last_ts"))


def tag_token_pairs(tags_clean: DataFrame, r: Roles = DEFAULT_ROLES) -> DataFrame:
    """Distinct (item, normalised tag) pairs with event counts and the X9 token.

    Pre-aggregating on (item, tag) spreads a hot item over its tags and cuts
    the rows before the token rule and any per-item step.
    """
    norm = f"{r.tag}_normalized"
    pairs = tags_clean.groupBy(r.item, norm).agg(
        F.count(F.lit(1)).alias("events"),
        F.min(r.epoch).alias("first_ts"),
        F.max(r.epoch).alias("last_ts"),
    )
    return pairs.withColumn("tag_token", X.normalize_token(norm))


def tag_stats(tags_clean: DataFrame, r: Roles = DEFAULT_ROLES) -> DataFrame:
    """A4: events, distinct tokens, sorted distinct token list, first/last time.
    NULL tokens still count as events."""
    pairs = tag_token_pairs(tags_clean, r)
    return pairs.groupBy(r.item).agg(
        F.sum("events").cast("bigint").alias("tag_event_count"),
        F.array_sort(F.collect_set("tag_token")).alias("tag_tokens"),
        F.min("first_ts").alias("first_tag_ts"),
        F.max("last_ts").alias("last_tag_ts"),
    ).withColumn("unique_tag_count", F.size("tag_tokens").cast("bigint"))


def item_tokens(tags_clean: DataFrame, catalog: DataFrame, r: Roles = DEFAULT_ROLES) -> DataFrame:
    """One row per (catalog item, token): events, first and last time; the events
    of an item without a usable token stand in a row with a NULL token.

    This long form is what vocabularies, indicators and counts need; no list of
    an item's tokens is built. Rows meet once, by (item, token): the token rule is cheap
    for plain words, so they are not grouped by their spelling first. The catalog's keys
    are hashed, so that the pairs need not be sorted to meet them."""
    tokens = tags_clean.select(r.item, X.normalize_token(f"{r.tag}_normalized").alias("tag_token"), r.epoch)
    return tokens.groupBy(r.item, "tag_token").agg(
        F.count(F.lit(1)).alias("events"), F.min(r.epoch).alias("first_ts"), F.max(r.epoch).alias("last_ts"),
    ).join(catalog.select(r.item).distinct().hint("shuffle_hash"), r.item, "left_semi")


def tag_summary(pairs: DataFrame, r: Roles = DEFAULT_ROLES) -> DataFrame:
    """A4 without the token list, from ``item_tokens``."""
    return pairs.groupBy(r.item).agg(
        F.sum("events").cast("bigint").alias("tag_event_count"),
        F.count("tag_token").alias("unique_tag_count"),
        F.min("first_ts").alias("first_tag_ts"),
        F.max("last_ts").alias("last_tag_ts"),
    )


def category_counts(item_categories: DataFrame, r: Roles = DEFAULT_ROLES) -> DataFrame:
    return item_categories.groupBy(r.item).agg(F.count(F.lit(1)).alias("genre_count"))


# --- F6 feature frame ------------------------------------------------------

def _frame(catalog: DataFrame, ra: DataFrame, ta: DataFrame, ga: DataFrame, r: Roles, lists: bool) -> DataFrame:
    # Global median of the year: a scalar subquery over a one-row aggregate
    # (its value->count map is bounded by the distinct years).
    year_median = A.median(catalog, "release_year").scalar()
    joined = catalog.join(ra, r.item, "left").join(ta, r.item, "left").join(ga, r.item, "left")
    whole = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    columns = [
        F.col(r.item), F.col(r.title), F.col("release_year"),
        F.coalesce(F.col("release_year").cast("double"), year_median).alias("release_year_filled"),
        F.col(f"{r.categories}_list").alias("genres_list") if lists else None,
        whole("genre_count").alias("genre_count"),
        F.col("tag_tokens") if lists else None, F.col(r.imdb), F.col(r.tmdb),
        whole("rating_count").alias("rating_count"),
        F.coalesce("avg_rating", F.lit(0.0)).alias("avg_rating"),
        F.coalesce("rating_std", F.lit(0.0)).alias("rating_std"),
        whole("unique_raters").alias("unique_raters"),
        whole(F.col("last_rating_ts") - F.col("first_rating_ts")).alias("rating_span_seconds"),
        whole("tag_event_count").alias("tag_event_count"),
        whole("unique_tag_count").alias("unique_tag_count"),
        whole(F.col("last_tag_ts") - F.col("first_tag_ts")).alias("tag_span_seconds"),
    ]
    return joined.select(*[c for c in columns if c is not None])


def feature_frame(catalog: DataFrame, ratings_clean: DataFrame, tags_clean: DataFrame,
                  item_categories: DataFrame, r: Roles = DEFAULT_ROLES) -> DataFrame:
    """one row per catalog item (unrated items kept), 17 columns."""
    return _frame(catalog, rating_stats(ratings_clean, r), tag_stats(tags_clean, r), category_counts(item_categories, r), r, True)


def model_frame(catalog: DataFrame, ratings_clean: DataFrame, pairs: DataFrame,
                item_categories: DataFrame, r: Roles = DEFAULT_ROLES) -> DataFrame:
    """F6 without its two list columns: the input of the model matrix.
    ``pairs`` comes from ``item_tokens``."""
    return _frame(catalog, rating_stats(ratings_clean, r), tag_summary(pairs, r), category_counts(item_categories, r), r, False)


def sanity_checks(frame: DataFrame) -> DataFrame:
    """Q14: rows, columns, items with ratings / tags / categories (one pass)."""
    n_cols = len(frame.columns)
    wide = frame.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.coalesce("rating_count", F.lit(0)) > 0).alias("with_ratings"),
        F.count_if(F.coalesce("tag_event_count", F.lit(0)) > 0).alias("with_tags"),
        F.count_if(F.coalesce("genre_count", F.lit(0)) > 0).alias("with_genres"),
    )
    return wide.selectExpr(
        "stack(5, 'feature rows', CAST(rows AS BIGINT), 'feature cols', CAST(%d AS BIGINT), "
        "'movies with ratings', CAST(with_ratings AS BIGINT), 'movies with tags', CAST(with_tags AS BIGINT), "
        "'movies with genres', CAST(with_genres AS BIGINT)) AS (`check`, value)" % n_cols)


# --- vocabularies (F7, F8, WN3) -------------------------------------------

def top_k_by_count(df: DataFrame, token_col: str, k: int, count_name: str = "len") -> DataFrame:
    """O2: top-k values by row count, ties broken by value (deterministic)."""
    counts = df.groupBy(token_col).agg(F.count(F.lit(1)).alias(count_name))
    return counts.orderBy(F.desc(count_name), F.asc(token_col)).limit(k)


def category_vocab(item_categories: DataFrame, k: int = 20, name: str = "genre") -> DataFrame:
    """the k categories with the most items, rank 0..k-1."""
    top = top_k_by_count(item_categories, name, k)
    w = Window.orderBy(F.desc("len"), F.asc(name))
    return top.withColumn("rank", (F.row_number().over(w) - 1).cast("int"))


def tag_vocab(pairs: DataFrame, k: int = 20) -> DataFrame:
    """F8 + WN3: the k tokens found on the most items, their position index
    and the feature name ``tag_<idx:03d>_<slug>``. ``pairs`` holds one row per
    (item, tag_token) (``item_tokens``)."""
    tokens = pairs.select(F.col("tag_token").alias("tag_tokens")).filter(F.col("tag_tokens").isNotNull())
    top = top_k_by_count(tokens, "tag_tokens", k)
    w = Window.orderBy(F.desc("len"), F.asc("tag_tokens"))
    idx = (F.row_number().over(w) - 1)
    return top.withColumns({
        "rank": idx.cast("int"),
        "feature": F.concat(F.lit("tag_"), F.lpad(idx.cast("string"), 3, "0"), F.lit("_"), X.slug_expr("tag_tokens")),
    })


# --- F9 scaling statistics -------------------------------------------------

def scaling_stats(frame: DataFrame) -> DataFrame:
    """one pass, one row. avg_rating statistics come from rated items only;
    std (ddof 1) that is NULL/NaN/0 falls back to 1, an empty rated set to (0, 1)."""
    rated = F.col("rating_count") > 0
    raw = frame.agg(
        F.avg("release_year_filled").alias("release_year_mean"),
        F.stddev_samp("release_year_filled").alias("release_year_std"),
        F.avg(F.when(rated, F.col("avg_rating"))).alias("avg_rating_mean"),
        F.stddev_samp(F.when(rated, F.col("avg_rating"))).alias("avg_rating_std"),
        F.avg("rating_span_seconds").alias("rating_span_mean"),
        F.stddev_samp("rating_span_seconds").alias("rating_span_std"),
        F.avg("tag_span_seconds").alias("tag_span_mean"),
        F.stddev_samp("tag_span_seconds").alias("tag_span_std"),
    )

    def fix_std(c):
        return F.when(F.col(c).isNull() | F.isnan(c) | (F.col(c) == 0), F.lit(1.0)).otherwise(F.col(c)).alias(c)

    return raw.select(
        F.col("release_year_mean"), fix_std("release_year_std"),
        F.coalesce("avg_rating_mean", F.lit(0.0)).alias("avg_rating_mean"), fix_std("avg_rating_std"),
        F.col("rating_span_mean"), fix_std("rating_span_std"),
        F.col("tag_span_mean"), fix_std("tag_span_std"),
    )


# --- F10-F12 model matrix ---------------------------------------------------

@dataclass
class ModelSpec:
    genre_tokens: list[str]
    genre_features: list[str]
    tag_tokens: list[str]
    tag_features: list[str]
    tag_item_counts: list[int]

    @property
    def feature_columns(self) -> list[str]:
        return NUMERIC_MODEL_FEATURES + self.genre_features + self.tag_features


def model_spec(item_categories: DataFrame, pairs: DataFrame, k_genres: int = 20, k_tags: int = 20) -> ModelSpec:
    """Bring the two vocabularies (at most k rows each) to the driver."""
    genres = category_vocab(item_categories, k_genres).withColumn("slug", X.slug_expr("genre")).orderBy("rank").collect()
    tags = tag_vocab(pairs, k_tags).orderBy("rank").collect()
    return ModelSpec(
        genre_tokens=[g["genre"] for g in genres],
        genre_features=unique_names([f"genre_{g['slug']}" for g in genres]),
        tag_tokens=[t["tag_tokens"] for t in tags],
        tag_features=[t["feature"] for t in tags],
        tag_item_counts=[int(t["len"]) for t in tags],
    )


def indicators(bridge: DataFrame, token: str, tokens: list[str], names: list[str], item: str) -> DataFrame:
    """One row per item that has any of the tokens, one 0/1 column per token."""
    hits = bridge.filter(F.col(token).isin(tokens))
    return hits.groupBy(item).agg(*[F.max((F.col(token) == F.lit(t)).cast("double")).alias(n) for t, n in zip(tokens, names)])


def model_matrix(frame: DataFrame, spec: ModelSpec, item_categories: DataFrame, pairs: DataFrame,
                 r: Roles = DEFAULT_ROLES) -> DataFrame:
    """ids + numeric features + genre and tag indicators.

    ``frame`` is ``model_frame`` or ``feature_frame``. Indicators come from the
    category bridge and the (item, token) pairs, cut down to the vocabularies
    before they are grouped by item. Scaling scalars are scalar subqueries over
    one aggregate of the frame (Catalyst merges them into a single subquery).
    """
    stats = scaling_stats(frame)
    st = {c: stats.select(c).scalar() for c in stats.columns}
    cols = [
        F.col(r.item), F.col(r.title),
        F.col("rating_std"),
        X.zscore("release_year_filled", st["release_year_mean"], st["release_year_std"]).alias("release_year_z"),
        X.zscore("avg_rating", st["avg_rating_mean"], st["avg_rating_std"]).alias("avg_rating_z"),
        X.log1p0("rating_count").alias("rating_count_log"),
        X.log1p0("tag_event_count").alias("tag_event_count_log"),
        X.log1p0("unique_tag_count").alias("unique_tag_count_log"),
        X.zscore("rating_span_seconds", st["rating_span_mean"], st["rating_span_std"]).alias("rating_span_seconds_z"),
        X.zscore("tag_span_seconds", st["tag_span_mean"], st["tag_span_std"]).alias("tag_span_seconds_z"),
        X.log1p0("genre_count").alias("genre_count_log"),
    ]
    joined = frame
    for bridge, token, tokens, names in ((item_categories, "genre", spec.genre_tokens, spec.genre_features),
                                         (pairs, "tag_token", spec.tag_tokens, spec.tag_features)):
        if names:
            joined = joined.join(indicators(bridge, token, tokens, names, r.item), r.item, "left")
            cols += [F.coalesce(F.col(f"`{n}`"), F.lit(0.0)).alias(n) for n in names]
    return joined.select(*cols)


def feature_catalog(spark, spec: ModelSpec) -> DataFrame:
    """feature, group, source, token, weight (bounded: <= 6 + 2k rows)."""
    rows = [(f, "numeric", "week03 aggregates", None, 1.0) for f in NUMERIC_MODEL_FEATURES]
    rows += [(f, "genre_top20", "movie_genres", g, 1.0) for g, f in zip(spec.genre_tokens, spec.genre_features)]
    rows += [(f, "tag_top20", "tag_tokens", t, 1.0) for t, f in zip(spec.tag_tokens, spec.tag_features)]
    return spark.createDataFrame(rows, "feature string, feature_group string, source string, token string, weight double")


def feature_profile(matrix: DataFrame, spec: ModelSpec) -> DataFrame:
    """block sizes and the number of items."""
    n_num, n_g, n_t = len(NUMERIC_MODEL_FEATURES), len(spec.genre_features), len(spec.tag_features)
    return matrix.agg(F.count(F.lit(1)).alias("n")).selectExpr(
        f"stack(5, 'numeric', CAST({n_num} AS BIGINT), 'genre_top20', CAST({n_g} AS BIGINT), "
        f"'tag_top20', CAST({n_t} AS BIGINT), 'total_features', CAST({n_num + n_g + n_t} AS BIGINT), "
        "'movies', CAST(n AS BIGINT)) AS (block, `count`)")


# --- script path (F1-F5) -----------------------------------------------------

def category_pivot(item_categories: DataFrame, categories: list[str], r: Roles = DEFAULT_ROLES,
                   name: str = "genre") -> DataFrame:
    """One-hot then group sum; a repeated category counts twice.
    The vocabulary is passed in; one conditional count per value in a single
    aggregate (what ``pivot`` with explicit values plans), with names made
    unique ignoring case."""
    names = unique_names([f"{name}_{c}" for c in categories])
    return item_categories.groupBy(r.item).agg(*[
        F.count_if(F.col(name) == F.lit(c)).cast("bigint").alias(n) for c, n in zip(categories, names)])


def category_values(item_categories: DataFrame, name: str = "genre") -> list[str]:
    """Distinct category values, sorted (bounded by the category vocabulary)."""
    return [row[0] for row in item_categories.select(name).distinct().orderBy(name).collect()]


def tag_text(tags: DataFrame, r: Roles = DEFAULT_ROLES) -> DataFrame:
    """Distinct raw tags joined by a blank (sorted), plus the event count.
    Distinct (item, tag) first, so a hot item is spread over its tags."""
    pairs = tags.groupBy(r.item, r.tag).agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy(r.item).agg(
        F.array_join(F.array_sort(F.collect_list(r.tag)), " ").alias("tag_text"),
        F.sum("n").cast("bigint").alias("tag_count"),
    )


def text_corpus(catalog: DataFrame, tag_text_df: DataFrame, r: Roles = DEFAULT_ROLES) -> DataFrame:
    """every catalog item, title + blank + tag text (NULL as empty)."""
    j = catalog.select(r.item, r.title).join(tag_text_df, r.item, "left")
    return j.select(
        r.item,
        F.concat(F.coalesce(F.col(r.title), F.lit("")), F.lit(" "), F.coalesce(F.col("tag_text"), F.lit(""))).alias("text_blob"),
        F.coalesce(F.col("tag_count"), F.lit(0)).cast("bigint").alias("tag_count"),
    )


def numeric_feature_matrix(ratings_clean: DataFrame, item_categories: DataFrame, tags: DataFrame,
                           categories: list[str], r: Roles = DEFAULT_ROLES) -> DataFrame:
    """rated items only (J3), rating stats + category counts + tag count, NULL -> 0."""
    rs = rating_stats_script(ratings_clean, r)
    cp = category_pivot(item_categories, categories, r)
    tc = tags.groupBy(r.item).agg(F.count(F.lit(1)).cast("bigint").alias("tag_count"))
    j = rs.join(cp, r.item, "left").join(tc, r.item, "left")
    return j.na.fill(0)


def model_matrix_long(frame: DataFrame, item_categories: DataFrame, pairs: DataFrame, spec: ModelSpec,
                      r: Roles = DEFAULT_ROLES) -> DataFrame:
    """F10 in long form (item, feature, value): the numeric features of every
    item plus the indicator entries that are 1.0 (zeros are implicit).

    The indicators come from the category bridge and the item-token pairs
    cut down to the vocabularies (at most k values each), never from an
    items x vocabulary product.
    """
    none = ModelSpec([], [], [], [], [])
    wide = model_matrix(frame, none, item_categories, pairs, r)
    numeric = wide.select(r.item, F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in NUMERIC_MODEL_FEATURES
    ])).alias("kv")).select(r.item, "kv.feature", "kv.value")
    out = numeric
    for bridge, token, tokens, names in ((item_categories, "genre", spec.genre_tokens, spec.genre_features),
                                         (pairs, "tag_token", spec.tag_tokens, spec.tag_features)):
        if names:
            name_of = F.create_map(*[F.lit(x) for kv in zip(tokens, names) for x in kv])
            hits = bridge.filter(F.col(token).isin(tokens)).select(r.item, token).distinct()
            out = out.unionByName(hits.select(r.item, name_of[F.col(token)].alias("feature"), F.lit(1.0).alias("value")))
    return out
