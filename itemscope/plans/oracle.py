"""DuckDB twins of the registered queries (independent SQL, same rules).

Doubles are rounded to 6 digits and lists are bar-joined text, exactly as
``plans.present`` shows the Spark side. Integer sums are cast to BIGINT.
"""

from __future__ import annotations

from itemscope.sources.fixtures import SQL_ROLES

R = 6  # rounding digits

# Unicode White_Space, spelled for RE2.
_WS = r"[\x09-\x0D\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"

CLEAN = {
    "catalog": rf"""
    SELECT m.movieId, m.title, m.genres, l.imdbId, l.tmdbId,
           TRY_CAST(nullif(regexp_extract(m.title, '\(([0-9]{{4}})\)$', 1), '') AS BIGINT) AS release_year,
           CASE WHEN m.genres = '(no genres listed)' THEN NULL ELSE m.genres END AS genres_raw,
           string_split(CASE WHEN m.genres = '(no genres listed)' THEN NULL ELSE m.genres END, '|') AS genres_list,
           CASE WHEN l.imdbId IS NOT NULL THEN 'tt' || CAST(l.imdbId AS VARCHAR) END AS imdb_title_id
    FROM (SELECT movieId, title, genres FROM movies WHERE movieId IS NOT NULL AND title IS NOT NULL) m
    LEFT JOIN (SELECT movieId, imdbId, tmdbId FROM links) l ON m.movieId = l.movieId""",
    "ratings_clean": """
    SELECT userId, movieId, rating, "timestamp", make_timestamp("timestamp" * 1000000) AS rated_at
    FROM ratings
    WHERE userId IS NOT NULL AND movieId IS NOT NULL AND rating IS NOT NULL AND "timestamp" IS NOT NULL
      AND rating >= 0.5 AND rating <= 5.0""",
    "tags_clean": rf"""
    SELECT userId, movieId, tag, "timestamp", lower(tag) AS tag_normalized,
           make_timestamp("timestamp" * 1000000) AS tagged_at
    FROM (SELECT userId, movieId, regexp_replace(tag, '^{_WS}+|{_WS}+$', '', 'g') AS tag, "timestamp"
          FROM tags
          WHERE userId IS NOT NULL AND movieId IS NOT NULL AND tag IS NOT NULL AND "timestamp" IS NOT NULL) s
    WHERE length(tag) > 0""",
    "item_genres": """
    SELECT movieId, genre FROM (SELECT movieId, unnest(genres_list) AS genre FROM catalog) x
    WHERE genre IS NOT NULL""",
}

TOKEN = (r"CASE WHEN length(lower(trim(regexp_replace(regexp_replace(tag_normalized, '[^\x00-\x7F]', '', 'g'), "
         r"'[\t\n\x0B\f\r\x1C-\x1F ]+', ' ', 'g')))) >= 2 THEN lower(trim(regexp_replace(regexp_replace("
         r"tag_normalized, '[^\x00-\x7F]', '', 'g'), '[\t\n\x0B\f\r\x1C-\x1F ]+', ' ', 'g'))) END")

DERIVED = {
    "rating_stats": """
    SELECT movieId, count(*) AS rating_count, avg(rating) AS avg_rating, stddev_samp(rating) AS rating_std,
           min(rating) AS min_rating, max(rating) AS max_rating, count(DISTINCT userId) AS unique_raters,
           min("timestamp") AS first_rating_ts, max("timestamp") AS last_rating_ts
    FROM ratings_clean GROUP BY movieId""",
    "tag_tok": f"""
    SELECT movieId, "timestamp", {TOKEN} AS tag_token FROM tags_clean""",
    "tag_stats": """
    SELECT movieId, count(*) AS tag_event_count, count(DISTINCT tag_token) AS unique_tag_count,
           list_sort(list_distinct(list(tag_token))) AS tag_tokens,
           min("timestamp") AS first_tag_ts, max("timestamp") AS last_tag_ts
    FROM tag_tok GROUP BY movieId""",
    "genre_counts": "SELECT movieId, count(*) AS genre_count FROM item_genres GROUP BY movieId",
    "feature_frame": """
    SELECT c.movieId, c.title, c.release_year,
           coalesce(CAST(c.release_year AS DOUBLE), (SELECT median(release_year) FROM catalog)) AS release_year_filled,
           c.genres_list, coalesce(g.genre_count, 0) AS genre_count, t.tag_tokens, c.imdbId, c.tmdbId,
           coalesce(r.rating_count, 0) AS rating_count, coalesce(r.avg_rating, 0.0) AS avg_rating,
           coalesce(r.rating_std, 0.0) AS rating_std, coalesce(r.unique_raters, 0) AS unique_raters,
           coalesce(r.last_rating_ts - r.first_rating_ts, 0) AS rating_span_seconds,
           coalesce(t.tag_event_count, 0) AS tag_event_count, coalesce(t.unique_tag_count, 0) AS unique_tag_count,
           coalesce(t.last_tag_ts - t.first_tag_ts, 0) AS tag_span_seconds
    FROM catalog c LEFT JOIN rating_stats r ON c.movieId = r.movieId
    LEFT JOIN tag_stats t ON c.movieId = t.movieId LEFT JOIN genre_counts g ON c.movieId = g.movieId""",
}

# dependencies of every named CTE
_DEPS = {
    "catalog": ["movies", "links"],
    "ratings_clean": ["ratings"],
    "tags_clean": ["tags"],
    "item_genres": ["catalog"],
    "rating_stats": ["ratings_clean"],
    "tag_tok": ["tags_clean"],
    "tag_stats": ["tag_tok"],
    "genre_counts": ["item_genres"],
    "feature_frame": ["catalog", "rating_stats", "tag_stats", "genre_counts"],
}
_BODIES = {**CLEAN, **DERIVED}


def with_ctes(body: str, needs: list[str], extra: dict[str, str] | None = None) -> str:
    """Build ``WITH role..., derived... body`` for the CTEs ``needs`` (transitively)."""
    extra = extra or {}
    deps = {**_DEPS, **{k: [] for k in extra}}
    bodies = {**_BODIES, **extra}
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in deps.get(n, []):
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    roles = [n for n in order if n in SQL_ROLES]
    derived = [n for n in order if n not in SQL_ROLES]
    ctes = [f"{n} AS ({SQL_ROLES[n]})" for n in roles] + [f"{n} AS ({bodies[n]})" for n in derived]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def rnd(expr: str, alias: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), {R}) AS {alias}"


def lst(expr: str, alias: str) -> str:
    return f"array_to_string({expr}, '|') AS {alias}"


ORACLE: dict[str, str] = {}

ORACLE["rating_features"] = with_ctes(f"""
SELECT movieId, rating_count, {rnd('avg_rating', 'avg_rating')}, {rnd('rating_std', 'rating_std')},
       {rnd('min_rating', 'min_rating')}, {rnd('max_rating', 'max_rating')}, unique_raters,
       first_rating_ts, last_rating_ts
FROM rating_stats""", ["rating_stats"])

ORACLE["rating_features_script"] = with_ctes(f"""
SELECT movieId, count(*) AS rating_count, {rnd('avg(rating)', 'rating_mean')}, {rnd('stddev_samp(rating)', 'rating_std')},
       {rnd('min(rating)', 'rating_min')}, {rnd('max(rating)', 'rating_max')}, {rnd('median(rating)', 'rating_median')},
       min("timestamp") AS rating_first_ts, max("timestamp") AS rating_last_ts,
       {rnd('(max("timestamp") - min("timestamp")) / 86400.0', 'rating_span_days')}
FROM ratings_clean GROUP BY movieId""", ["ratings_clean"])

ORACLE["clean_catalog"] = with_ctes(f"""
SELECT movieId, title, genres, imdbId, tmdbId, release_year, genres_raw, {lst('genres_list', 'genres_list')}, imdb_title_id
FROM catalog""", ["catalog"])

ORACLE["clean_interactions"] = with_ctes(f"""
SELECT userId, movieId, {rnd('rating', 'rating')}, "timestamp", rated_at FROM ratings_clean""", ["ratings_clean"])

ORACLE["clean_tags"] = with_ctes("""
SELECT userId, movieId, tag, "timestamp", tag_normalized, tagged_at FROM tags_clean""", ["tags_clean"])

ORACLE["item_categories"] = with_ctes("SELECT movieId, genre FROM item_genres", ["item_genres"])

ORACLE["tag_features"] = with_ctes(f"""
SELECT movieId, CAST(tag_event_count AS BIGINT) AS tag_event_count, {lst('tag_tokens', 'tag_tokens')},
       first_tag_ts, last_tag_ts, CAST(unique_tag_count AS BIGINT) AS unique_tag_count
FROM tag_stats""", ["tag_stats"])

ORACLE["feature_frame"] = with_ctes(f"""
SELECT movieId, title, release_year, {rnd('release_year_filled', 'release_year_filled')},
       {lst('genres_list', 'genres_list')}, CAST(genre_count AS BIGINT) AS genre_count,
       {lst('tag_tokens', 'tag_tokens')}, imdbId, tmdbId, CAST(rating_count AS BIGINT) AS rating_count,
       {rnd('avg_rating', 'avg_rating')}, {rnd('rating_std', 'rating_std')}, CAST(unique_raters AS BIGINT) AS unique_raters,
       CAST(rating_span_seconds AS BIGINT) AS rating_span_seconds, CAST(tag_event_count AS BIGINT) AS tag_event_count,
       CAST(unique_tag_count AS BIGINT) AS unique_tag_count, CAST(tag_span_seconds AS BIGINT) AS tag_span_seconds
FROM feature_frame""", ["feature_frame"])

ORACLE["sanity_checks"] = with_ctes("""
SELECT * FROM (VALUES
  ('feature rows', (SELECT count(*) FROM feature_frame)),
  ('feature cols', 17),
  ('movies with ratings', (SELECT count(*) FROM feature_frame WHERE rating_count > 0)),
  ('movies with tags', (SELECT count(*) FROM feature_frame WHERE tag_event_count > 0)),
  ('movies with genres', (SELECT count(*) FROM feature_frame WHERE genre_count > 0))
) v("check", value)""", ["feature_frame"])


# --- profile and audit -------------------------------------------------------------------

from itemscope.roles import ALL_TABLES, CORE_TABLES, RAW_SCHEMAS  # noqa: E402

# Types of the cleaned tables as Spark names them (the schema side of Q10).
CLEAN_SCHEMAS = {
    "catalog": [("movieId", "bigint"), ("title", "string"), ("genres", "string"), ("imdbId", "bigint"),
                ("tmdbId", "bigint"), ("release_year", "bigint"), ("genres_raw", "string"),
                ("genres_list", "array<string>"), ("imdb_title_id", "string")],
    "ratings_clean": [("userId", "bigint"), ("movieId", "bigint"), ("rating", "double"),
                      ("timestamp", "bigint"), ("rated_at", "timestamp_ntz")],
    "tags_clean": [("userId", "bigint"), ("movieId", "bigint"), ("tag", "string"), ("timestamp", "bigint"),
                   ("tag_normalized", "string"), ("tagged_at", "timestamp_ntz")],
    "item_genres": [("movieId", "bigint"), ("genre", "string")],
}
RAW_COLS = {t: [(f.name, f.dataType.simpleString()) for f in RAW_SCHEMAS[t].fields] for t in ALL_TABLES}


def _q(c: str) -> str:
    return f'"{c}"'


def _missing_sql(schemas: dict[str, list[tuple[str, str]]], with_type: bool = False) -> str:
    parts = []
    for t, cols in schemas.items():
        for c, typ in cols:
            tcol = f"'{typ}' AS dtype, " if with_type else ""
            parts.append(
                f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", {tcol}"
                f"CAST(count(*) FILTER (WHERE {_q(c)} IS NULL) AS BIGINT) AS null_count, "
                f"CASE WHEN count(*) > 0 THEN round(100.0 * count(*) FILTER (WHERE {_q(c)} IS NULL) / count(*), 4) "
                f"ELSE 0.0 END AS null_pct FROM {t}")
    return "\nUNION ALL ".join(parts)


def _dup_sql(table: str, keys: list[str]) -> str:
    k = ", ".join(_q(c) for c in keys)
    return (f"SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_members FROM "
            f"(SELECT count(*) AS n FROM {table} GROUP BY {k} HAVING count(*) > 1) d")


_ALL_RAW = list(ALL_TABLES)

ORACLE["table_shapes"] = with_ctes("\nUNION ALL ".join(
    f"SELECT '{t}' AS \"table\", count(*) AS rows, CAST({len(RAW_COLS[t])} AS BIGINT) AS cols, "
    f"'{'core' if t in CORE_TABLES else 'optional'}' AS scope FROM {t}" for t in ALL_TABLES), _ALL_RAW)

# the names the cleaned tables are stored under
STORED_NAMES = {"catalog": "movies_catalog", "ratings_clean": "ratings_clean", "tags_clean": "tags_clean",
                "item_genres": "movie_genres"}
_STORED_CASE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STORED_NAMES.items())

ORACLE["load_summary"] = with_ctes("\nUNION ALL ".join(
    f"SELECT '{STORED_NAMES[t]}' AS \"table\", count(*) AS rows, CAST({len(cols)} AS BIGINT) AS cols, 'core' AS scope FROM {t}"
    for t, cols in CLEAN_SCHEMAS.items()), list(CLEAN_SCHEMAS))

_SCHEMA_VALUES = ", ".join(f"('{t}', '{c}', '{typ}')" for t in ALL_TABLES for c, typ in RAW_COLS[t])

_MISSING = {"missing": _missing_sql(RAW_COLS)}
ORACLE["missing_profile"] = with_ctes(f"SELECT \"table\", \"column\", null_count, {rnd('null_pct', 'null_pct')} FROM missing",
                                      _ALL_RAW + ["missing"], _MISSING)
ORACLE["missing_nonzero"] = with_ctes(
    f"SELECT \"table\", \"column\", null_count, {rnd('null_pct', 'null_pct')} FROM missing WHERE null_count > 0",
    _ALL_RAW + ["missing"], _MISSING)

ORACLE["quality_checks"] = with_ctes(f"""
SELECT 'ratings_missing_required' AS "check", CAST(count(*) FILTER (WHERE userId IS NULL OR movieId IS NULL OR rating IS NULL OR "timestamp" IS NULL) AS BIGINT) AS value FROM ratings
UNION ALL SELECT 'ratings_out_of_range', CAST(count(*) FILTER (WHERE rating < 0.5 OR rating > 5.0) AS BIGINT) FROM ratings
UNION ALL SELECT 'ratings_duplicate_user_movie_pairs', * FROM ({_dup_sql('ratings', ['userId', 'movieId'])})
UNION ALL SELECT 'movies_duplicate_movieId', * FROM ({_dup_sql('movies', ['movieId'])})
UNION ALL SELECT 'movies_missing_title', CAST(count(*) FILTER (WHERE title IS NULL) AS BIGINT) FROM movies
UNION ALL SELECT 'movies_missing_genres', CAST(count(*) FILTER (WHERE genres IS NULL) AS BIGINT) FROM movies
UNION ALL SELECT 'tags_missing_tag_text', CAST(count(*) FILTER (WHERE tag IS NULL) AS BIGINT) FROM tags
UNION ALL SELECT 'tags_duplicate_full_rows', * FROM ({_dup_sql('tags', ['userId', 'movieId', 'tag', 'timestamp'])})
UNION ALL SELECT 'links_missing_imdbId', CAST(count(*) FILTER (WHERE imdbId IS NULL) AS BIGINT) FROM links
UNION ALL SELECT 'links_missing_tmdbId', CAST(count(*) FILTER (WHERE tmdbId IS NULL) AS BIGINT) FROM links
UNION ALL SELECT 'links_duplicate_movieId', * FROM ({_dup_sql('links', ['movieId'])})
UNION ALL SELECT 'genome_scores_duplicate_movie_tag', * FROM ({_dup_sql('genome_scores', ['movieId', 'tagId'])})
UNION ALL SELECT 'genome_tags_duplicate_tagId', * FROM ({_dup_sql('genome_tags', ['tagId'])})""", _ALL_RAW)

ORACLE["duplicate_members_single"] = with_ctes(_dup_sql("ratings", ["movieId"]), ["ratings"])
ORACLE["duplicate_members_composite"] = with_ctes(_dup_sql("ratings", ["userId", "movieId"]), ["ratings"])
ORACLE["duplicate_members_fullrow"] = with_ctes(_dup_sql("tags", ["userId", "movieId", "tag", "timestamp"]), ["tags"])


def _coverage_sql(child: str, parent: str, key: str, label: str) -> str:
    return (f"SELECT '{label}' AS relationship_check, "
            f"CAST(count(*) FILTER (WHERE p.k IS NULL) AS BIGINT) AS unmatched_count, "
            f"round(round((1 - count(*) FILTER (WHERE p.k IS NULL) / greatest(count(*), 1)) * 100, 4), {R}) AS coverage_pct "
            f"FROM (SELECT DISTINCT {key} AS k FROM {child}) c "
            f"LEFT JOIN (SELECT DISTINCT {key} AS k FROM {parent}) p ON c.k = p.k")


ORACLE["join_coverage"] = with_ctes("\nUNION ALL ".join([
    _coverage_sql("ratings", "movies", "movieId", "ratings movieId matched in movies"),
    _coverage_sql("tags", "movies", "movieId", "tags movieId matched in movies"),
    _coverage_sql("genome_scores", "movies", "movieId", "genome_scores movieId matched in movies"),
    _coverage_sql("genome_scores", "genome_tags", "tagId", "genome_scores tagId matched in genome_tags"),
]), _ALL_RAW)

ORACLE["orphan_keys"] = with_ctes("""
SELECT 'ratings.movieId in movies_clean.movieId' AS relationship,
       (SELECT count(*) FROM (SELECT DISTINCT movieId FROM ratings_clean) c ANTI JOIN (SELECT DISTINCT movieId FROM catalog) p ON c.movieId = p.movieId) AS unmatched_count
UNION ALL
SELECT 'tags.movieId in movies_clean.movieId',
       (SELECT count(*) FROM (SELECT DISTINCT movieId FROM tags_clean) c ANTI JOIN (SELECT DISTINCT movieId FROM catalog) p ON c.movieId = p.movieId)""",
    ["ratings_clean", "tags_clean", "catalog"])

ORACLE["scale_metrics"] = with_ctes(f"""
SELECT users, items, interactions, users * items AS possible_user_item_pairs,
       CASE WHEN users * items > 0 THEN round(round(interactions / (users * items) * 100, 6), {R}) ELSE 0.0 END AS density_pct,
       CASE WHEN users * items > 0 THEN round(round((1 - interactions / (users * items)) * 100, 6), {R}) ELSE 0.0 END AS sparsity_pct
FROM (SELECT CAST(count(DISTINCT userId) + coalesce(max(CASE WHEN userId IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT) AS users,
             CAST(count(DISTINCT movieId) + coalesce(max(CASE WHEN movieId IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT) AS items,
             CAST(count(*) AS BIGINT) AS interactions FROM ratings) s""", ["ratings"])

ORACLE["score_distribution"] = with_ctes(
    f"SELECT {rnd('rating', 'rating')}, count(*) AS len FROM ratings GROUP BY rating", ["ratings"])

ORACLE["top_categories_raw"] = with_ctes("""
SELECT genres, count(*) AS len FROM (SELECT unnest(string_split(genres, '|')) AS genres FROM movies) x
GROUP BY genres ORDER BY len DESC, genres ASC NULLS LAST LIMIT 15""", ["movies"])

ORACLE["event_time_range"] = with_ctes("""
SELECT min("timestamp") AS min_ts, max("timestamp") AS max_ts,
       make_timestamp(min("timestamp") * 1000000) AS min_time, make_timestamp(max("timestamp") * 1000000) AS max_time
FROM ratings""", ["ratings"])

ORACLE["data_dictionary"] = with_ctes(f"""
SELECT s."table", s."column", s.sample_dtype, coalesce(m.null_count, 0) AS null_count,
       {rnd('coalesce(m.null_pct, 0.0)', 'null_pct')}
FROM (VALUES {_SCHEMA_VALUES}) s("table", "column", sample_dtype)
LEFT JOIN missing m ON s."table" = m."table" AND s."column" = m."column" """, _ALL_RAW + ["missing"], _MISSING)

ORACLE["processed_dictionary"] = with_ctes(
    f"SELECT CASE \"table\" {_STORED_CASE} END AS \"table\", \"column\", dtype, null_count, {rnd('null_pct', 'null_pct')} FROM pmissing",
    list(CLEAN_SCHEMAS) + ["pmissing"], {"pmissing": _missing_sql(CLEAN_SCHEMAS, with_type=True)})

ORACLE["rows_before_after"] = with_ctes("""
SELECT "table", raw_rows, clean_rows, raw_rows - clean_rows AS rows_removed FROM (
  SELECT 'movies' AS "table", (SELECT count(*) FROM movies) AS raw_rows, (SELECT count(*) FROM catalog) AS clean_rows
  UNION ALL SELECT 'ratings', (SELECT count(*) FROM ratings), (SELECT count(*) FROM ratings_clean)
  UNION ALL SELECT 'tags', (SELECT count(*) FROM tags), (SELECT count(*) FROM tags_clean)
  UNION ALL SELECT 'links_as_joined_columns', (SELECT count(*) FROM links), (SELECT count(*) FROM catalog)) x""",
    ["movies", "ratings", "tags", "links", "catalog", "ratings_clean", "tags_clean"])

ORACLE["uniqueness_report"] = with_ctes(f"""
SELECT 'movies_catalog' AS "table", 'movieId' AS key_columns, duplicate_members, duplicate_members = 0 AS "unique"
FROM ({_dup_sql('catalog', ['movieId'])})
UNION ALL
SELECT 'ratings_clean', 'userId,movieId', duplicate_members, duplicate_members = 0
FROM ({_dup_sql('ratings_clean', ['userId', 'movieId'])})""", ["catalog", "ratings_clean"])


# --- vocabularies, scaling, model matrix, script features -----------------------------------

def _slug(x: str) -> str:
    s = f"trim(regexp_replace(lower(trim({x})), '[^a-zA-Z0-9]+', '_', 'g'), '_')"
    return f"CASE WHEN length({s}) > 0 THEN {s} ELSE 'token' END"


_VOCAB = {
    "genre_vocab": """
    SELECT genre, count(*) AS len FROM item_genres GROUP BY genre ORDER BY len DESC, genre ASC LIMIT 20""",
    "tag_vocab": """
    SELECT tok AS tag_tokens, count(*) AS len
    FROM (SELECT unnest(tag_tokens) AS tok FROM feature_frame) x WHERE tok IS NOT NULL
    GROUP BY tok ORDER BY len DESC, tok ASC LIMIT 20""",
    "stats": """
    SELECT avg(release_year_filled) AS release_year_mean,
           coalesce(nullif(CASE WHEN isnan(stddev_samp(release_year_filled)) THEN 0 ELSE stddev_samp(release_year_filled) END, 0), 1.0) AS release_year_std,
           coalesce(avg(avg_rating) FILTER (WHERE rating_count > 0), 0.0) AS avg_rating_mean,
           coalesce(nullif(stddev_samp(avg_rating) FILTER (WHERE rating_count > 0), 0), 1.0) AS avg_rating_std,
           avg(rating_span_seconds) AS rating_span_mean,
           coalesce(nullif(stddev_samp(rating_span_seconds), 0), 1.0) AS rating_span_std,
           avg(tag_span_seconds) AS tag_span_mean,
           coalesce(nullif(stddev_samp(tag_span_seconds), 0), 1.0) AS tag_span_std
    FROM feature_frame""",
}
_VOCAB_NEEDS = ["feature_frame", "item_genres", "genre_vocab", "tag_vocab", "stats"]

ORACLE["category_vocab"] = with_ctes(
    "SELECT genre, len, CAST(row_number() OVER (ORDER BY len DESC, genre ASC) - 1 AS INTEGER) AS rank FROM genre_vocab",
    _VOCAB_NEEDS, _VOCAB)

_TAG_RANK = "row_number() OVER (ORDER BY len DESC, tag_tokens ASC) - 1"
ORACLE["tag_vocab"] = with_ctes(
    f"SELECT tag_tokens, len, CAST({_TAG_RANK} AS INTEGER) AS rank, "
    f"'tag_' || lpad(CAST({_TAG_RANK} AS VARCHAR), 3, '0') || '_' || {_slug('tag_tokens')} AS feature FROM tag_vocab",
    _VOCAB_NEEDS, _VOCAB)

ORACLE["scaling_stats"] = with_ctes("SELECT " + ", ".join(rnd(c, c) for c in [
    "release_year_mean", "release_year_std", "avg_rating_mean", "avg_rating_std",
    "rating_span_mean", "rating_span_std", "tag_span_mean", "tag_span_std"]) + " FROM stats", _VOCAB_NEEDS, _VOCAB)

_NUMERIC_LONG = """
    SELECT f.movieId, v.feature, v.value FROM (
      SELECT movieId,
        coalesce((CAST(release_year_filled AS DOUBLE) - s.release_year_mean) / s.release_year_std, 0.0) AS release_year_z,
        coalesce((avg_rating - s.avg_rating_mean) / s.avg_rating_std, 0.0) AS avg_rating_z,
        rating_std,
        ln(1 + coalesce(CAST(rating_count AS DOUBLE), 0.0)) AS rating_count_log,
        ln(1 + coalesce(CAST(unique_tag_count AS DOUBLE), 0.0)) AS unique_tag_count_log,
        ln(1 + coalesce(CAST(genre_count AS DOUBLE), 0.0)) AS genre_count_log
      FROM feature_frame, stats s) f,
    LATERAL (VALUES ('release_year_z', f.release_year_z), ('avg_rating_z', f.avg_rating_z),
                    ('rating_std', f.rating_std), ('rating_count_log', f.rating_count_log),
                    ('unique_tag_count_log', f.unique_tag_count_log), ('genre_count_log', f.genre_count_log)) v(feature, value)"""
_GENRE_FEATURES = (
    "SELECT token, CASE WHEN n = 1 THEN feature ELSE feature || '_' || CAST(n AS VARCHAR) END AS feature FROM ("
    f"SELECT genre AS token, 'genre_' || {_slug('genre')} AS feature, row_number() OVER ("
    f"PARTITION BY lower('genre_' || {_slug('genre')}) ORDER BY len DESC, genre ASC) AS n FROM genre_vocab) gv")
_TAG_FEATURES = (f"SELECT tag_tokens AS token, 'tag_' || lpad(CAST({_TAG_RANK} AS VARCHAR), 3, '0') || '_' || "
                 f"{_slug('tag_tokens')} AS feature FROM tag_vocab")

ORACLE["model_matrix_long"] = with_ctes(f"""
SELECT movieId, feature, {rnd('value', 'value')} FROM (
  {_NUMERIC_LONG}
  UNION ALL
  SELECT g.movieId, gf.feature, 1.0 FROM (SELECT DISTINCT movieId, genre FROM item_genres) g
  JOIN ({_GENRE_FEATURES}) gf ON g.genre = gf.token
  UNION ALL
  SELECT t.movieId, tf.feature, 1.0 FROM (SELECT movieId, unnest(tag_tokens) AS token FROM feature_frame) t
  JOIN ({_TAG_FEATURES}) tf ON t.token = tf.token) x""", _VOCAB_NEEDS, _VOCAB)

ORACLE["feature_catalog"] = with_ctes(f"""
SELECT feature, 'numeric' AS feature_group, 'week03 aggregates' AS source, CAST(NULL AS VARCHAR) AS token, CAST(1.0 AS DOUBLE) AS weight
FROM (VALUES ('release_year_z'), ('avg_rating_z'), ('rating_std'), ('rating_count_log'),
             ('unique_tag_count_log'), ('genre_count_log')) v(feature)
UNION ALL SELECT feature, 'genre_top20', 'movie_genres', token, 1.0 FROM ({_GENRE_FEATURES})
UNION ALL SELECT feature, 'tag_top20', 'tag_tokens', token, 1.0 FROM ({_TAG_FEATURES})""", _VOCAB_NEEDS, _VOCAB)

ORACLE["feature_profile"] = with_ctes("""
SELECT * FROM (VALUES
  ('numeric', CAST(6 AS BIGINT)),
  ('genre_top20', (SELECT count(*) FROM genre_vocab)),
  ('tag_top20', (SELECT count(*) FROM tag_vocab)),
  ('total_features', 6 + (SELECT count(*) FROM genre_vocab) + (SELECT count(*) FROM tag_vocab)),
  ('movies', (SELECT count(*) FROM feature_frame))) v(block, "count")""", _VOCAB_NEEDS, _VOCAB)

_TAG_TEXT = {"tag_text": """
    SELECT movieId, array_to_string(list_sort(list_distinct(list(tag))), ' ') AS tag_text, count(*) AS tag_count
    FROM tags_clean GROUP BY movieId"""}
ORACLE["tag_text"] = with_ctes("SELECT movieId, tag_text, CAST(tag_count AS BIGINT) AS tag_count FROM tag_text",
                               ["tags_clean", "tag_text"], _TAG_TEXT)
ORACLE["text_corpus"] = with_ctes("""
SELECT c.movieId, coalesce(c.title, '') || ' ' || coalesce(t.tag_text, '') AS text_blob,
       CAST(coalesce(t.tag_count, 0) AS BIGINT) AS tag_count
FROM catalog c LEFT JOIN tag_text t ON c.movieId = t.movieId""", ["catalog", "tags_clean", "tag_text"], _TAG_TEXT)


# --- PCA inputs -----------------------------------------------------------------------------

_FULL = dict(_VOCAB)
_FULL["full_long"] = f"""
    {_NUMERIC_LONG}
    UNION ALL
    SELECT f.movieId, gf.feature, CASE WHEN coalesce(list_contains(f.genres_list, gf.token), false) THEN 1.0 ELSE 0.0 END
    FROM feature_frame f CROSS JOIN ({_GENRE_FEATURES}) gf
    UNION ALL
    SELECT f.movieId, tf.feature, CASE WHEN coalesce(list_contains(f.tag_tokens, tf.token), false) THEN 1.0 ELSE 0.0 END
    FROM feature_frame f CROSS JOIN ({_TAG_FEATURES}) tf"""
_FULL["zlong"] = """
    SELECT movieId, feature, value, stddev_pop(value) OVER (PARTITION BY feature) AS sd,
           (value - avg(value) OVER (PARTITION BY feature)) /
           CASE WHEN stddev_pop(value) OVER (PARTITION BY feature) > 0
                THEN stddev_pop(value) OVER (PARTITION BY feature) ELSE 1.0 END AS z
    FROM full_long"""
_FULL_NEEDS = _VOCAB_NEEDS + ["full_long", "zlong"]

ORACLE["standardized_matrix"] = with_ctes(f"SELECT movieId, feature, {rnd('z', 'value')} FROM zlong",
                                          _FULL_NEEDS, _FULL)
ORACLE["correlation_matrix"] = with_ctes(f"""
SELECT a.feature AS feature_a, b.feature AS feature_b,
       {rnd('CASE WHEN max(a.sd) > 0 AND max(b.sd) > 0 THEN sum(a.z * b.z) / count(*) END', 'correlation')}
FROM zlong a JOIN zlong b ON a.movieId = b.movieId
GROUP BY a.feature, b.feature""", _FULL_NEEDS, _FULL)


# --- TF-IDF -------------------------------------------------------------------------------------

from itemscope.functions.stopwords import ENGLISH  # noqa: E402

_STOP = ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH)
_TEXT = dict(_TAG_TEXT)
_TEXT["corpus"] = """
    SELECT c.movieId, coalesce(c.title, '') || ' ' || coalesce(t.tag_text, '') AS text_blob
    FROM catalog c LEFT JOIN tag_text t ON c.movieId = t.movieId"""
_TEXT["tf"] = rf"""
    SELECT movieId, term, count(*) AS tf FROM (
      SELECT movieId, unnest(regexp_extract_all(lower(text_blob), '[\p{{L}}\p{{N}}_]{{2,}}')) AS term FROM corpus) x
    WHERE term NOT IN ({_STOP}) GROUP BY movieId, term"""
_TEXT["vocab"] = """
    SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS term_idx, df,
           ln((1 + n) / (1 + df)) + 1 AS idf
    FROM (SELECT term, count(*) AS df, sum(tf) AS total FROM tf GROUP BY term
          HAVING count(*) >= 2 ORDER BY total DESC, term ASC LIMIT 5000) v,
         (SELECT CAST(count(*) AS DOUBLE) AS n FROM corpus) c"""
_TEXT_NEEDS = ["catalog", "tags_clean", "tag_text", "corpus", "tf", "vocab"]

ORACLE["tfidf_vocab"] = with_ctes(f"SELECT term, term_idx, CAST(df AS BIGINT) AS df, {rnd('idf', 'idf')} FROM vocab",
                                  _TEXT_NEEDS, _TEXT)
ORACLE["tfidf_long"] = with_ctes(f"""
SELECT movieId, term_idx, term, {rnd('w / sqrt(sum(w * w) OVER (PARTITION BY movieId))', 'weight')}
FROM (SELECT tf.movieId, v.term_idx, v.term, tf.tf * v.idf AS w FROM tf JOIN vocab v ON tf.term = v.term) x""",
    _TEXT_NEEDS, _TEXT)


# --- tag statistics on the events role ------------------------------------------------------

_EV = {
    "tags_clean_ev": CLEAN["tags_clean"].replace("FROM tags\n", "FROM tags_events\n"),
}
_EV["tag_tok_ev"] = DERIVED["tag_tok"].replace("tags_clean", "tags_clean_ev")
_EV["tag_stats_ev"] = DERIVED["tag_stats"].replace("FROM tag_tok GROUP BY", "FROM tag_tok_ev GROUP BY")
ORACLE["tag_features_events"] = with_ctes(f"""
SELECT movieId, CAST(tag_event_count AS BIGINT) AS tag_event_count, {lst('tag_tokens', 'tag_tokens')},
       first_tag_ts, last_tag_ts, CAST(unique_tag_count AS BIGINT) AS unique_tag_count
FROM tag_stats_ev""", ["tags_events", "tags_clean_ev", "tag_tok_ev", "tag_stats_ev"], _EV)


# --- long forms -----------------------------------------------------------------------------------

ORACLE["category_counts_long"] = with_ctes(
    "SELECT movieId, genre, count(*) AS n FROM item_genres GROUP BY movieId, genre", ["item_genres"])

_NUMERIC_CELLS = """
  SELECT s.movieId, v.feature, coalesce(v.value, 0.0) AS value FROM (
    SELECT movieId, CAST(count(*) AS DOUBLE) AS n, avg(rating) AS mean, stddev_samp(rating) AS sd, min(rating) AS lo, max(rating) AS hi,
           median(rating) AS med, CAST(min("timestamp") AS DOUBLE) AS t0, CAST(max("timestamp") AS DOUBLE) AS t1,
           (max("timestamp") - min("timestamp")) / 86400.0 AS days
    FROM ratings_clean GROUP BY movieId) s,
  LATERAL (VALUES ('rating_count', s.n), ('rating_mean', s.mean), ('rating_std', s.sd), ('rating_min', s.lo), ('rating_max', s.hi),
                  ('rating_median', s.med), ('rating_first_ts', s.t0), ('rating_last_ts', s.t1), ('rating_span_days', s.days)) v(feature, value)
  UNION ALL
  SELECT movieId, 'genre_' || genre, CAST(count(*) AS DOUBLE) FROM item_genres
  WHERE movieId IN (SELECT movieId FROM ratings_clean) GROUP BY movieId, genre
  UNION ALL
  SELECT movieId, 'tag_count', CAST(count(*) AS DOUBLE) FROM tags_clean
  WHERE movieId IN (SELECT movieId FROM ratings_clean) GROUP BY movieId"""
ORACLE["numeric_features_long"] = with_ctes(f"SELECT movieId, feature, {rnd('value', 'value')} FROM ({_NUMERIC_CELLS}) x",
                                            ["ratings_clean", "item_genres", "tags_clean"])

ORACLE["category_vectors"] = with_ctes("""
SELECT c.movieId, '[' || string_agg(CAST(v.idx AS VARCHAR), ',' ORDER BY v.idx) || ']' AS indices,
       '[' || string_agg(CAST(c.n AS VARCHAR), ',' ORDER BY v.idx) || ']' AS "values"
FROM (SELECT movieId, genre, count(*) AS n FROM item_genres GROUP BY movieId, genre) c
JOIN (SELECT genre, row_number() OVER (ORDER BY genre) - 1 AS idx FROM (SELECT DISTINCT genre FROM item_genres) g) v ON c.genre = v.genre
GROUP BY c.movieId""", ["item_genres"])

ORACLE["numeric_feature_vectors"] = with_ctes(f"""
SELECT c.movieId, CAST(v.idx AS INTEGER) AS idx, c.feature, {rnd('c.value', 'value')}
FROM numeric_cells c
JOIN (SELECT feature, row_number() OVER (ORDER BY feature) - 1 AS idx FROM (SELECT DISTINCT feature FROM numeric_cells) f) v ON c.feature = v.feature""",
                                              ["ratings_clean", "item_genres", "tags_clean", "numeric_cells"], {"numeric_cells": _NUMERIC_CELLS})

_PAIRS = """(VALUES ('rating_count_log', 'avg_rating_z', 'redundancy'), ('genre_count_log', 'rating_count_log', 'redundancy'),
             ('genre_count_log', 'unique_tag_count_log', 'diversity')) p(feature_a, feature_b, "check")"""
ORACLE["redundancy_correlation"] = with_ctes(f"""
SELECT p.feature_a, p.feature_b, p."check", {rnd('corr(a.value, b.value)', 'correlation')}
FROM {_PAIRS}
JOIN full_long a ON a.feature = p.feature_a JOIN full_long b ON b.feature = p.feature_b AND a.movieId = b.movieId
GROUP BY p.feature_a, p.feature_b, p."check" """, _FULL_NEEDS, _FULL)

ORACLE["redundancy_check"] = with_ctes(f"""
SELECT feature_a, feature_b, "check", {rnd('r', 'correlation')},
       CASE WHEN "check" = 'diversity' THEN CASE WHEN abs(r) > 0.6 THEN 'potentially redundant' ELSE 'diverse signals' END
            WHEN abs(r) > 0.7 THEN 'highly correlated' WHEN abs(r) > 0.5 THEN 'moderately correlated' ELSE 'independent' END AS label,
       CAST(0.0 AS DOUBLE) AS angle_residual
FROM (SELECT p.feature_a, p.feature_b, p."check", corr(a.value, b.value) AS r FROM {_PAIRS}
      JOIN full_long a ON a.feature = p.feature_a JOIN full_long b ON b.feature = p.feature_b AND a.movieId = b.movieId
      GROUP BY p.feature_a, p.feature_b, p."check") x""", _FULL_NEEDS, _FULL)

ORACLE["scatter_sample_by_md5"] = with_ctes(f"""
SELECT movieId, {rnd('ln(1 + n)', 'rating_count')} FROM (
  SELECT movieId, CAST(count(*) AS DOUBLE) AS n FROM ratings_clean GROUP BY movieId
  ORDER BY md5(CAST(movieId AS VARCHAR) || ':42'), movieId LIMIT 10000) x""", ["ratings_clean"])

ORACLE["table_memory_rows"] = ORACLE["table_shapes"]


# --- certificates -------------------------------------------------------------------------------

_POWERS = """
    SELECT (SELECT count(DISTINCT movieId) FROM {long}) AS items, (SELECT count(DISTINCT feature) FROM {long}) AS features,
           (SELECT sum(r) FROM {r} WHERE a = b) AS trace, (SELECT sum(r * r) FROM {r}) AS square,
           (SELECT sum(x.r * y.r * z.r) FROM {r} x JOIN {r} y ON x.b = y.a JOIN {r} z ON y.b = z.a AND z.b = x.a) AS cube"""


def _certificate_sql(zlong: str, residuals: list[str], needs: list[str], ctes: dict[str, str]) -> str:
    """Traces of the powers of the correlation matrix of a standardised long matrix; residuals are 0."""
    own = dict(ctes)
    own["corr_r"] = f"SELECT a.feature AS a, b.feature AS b, sum(a.z * b.z) / count(*) AS r FROM {zlong} a JOIN {zlong} b ON a.movieId = b.movieId GROUP BY a.feature, b.feature"
    own["powers"] = _POWERS.format(long=zlong, r="corr_r")
    rows = ["('items', CAST(p.items AS DOUBLE))", "('features', CAST(p.features AS DOUBLE))", "('trace', p.trace)", "('trace_of_square', p.square)",
            "('trace_of_cube', p.cube)", *[f"('{r}', 0.0)" for r in residuals]]
    return with_ctes(f"SELECT v.metric, {rnd('v.value', 'value')} FROM powers p, LATERAL (VALUES {', '.join(rows)}) v(metric, value)",
                     [*needs, "corr_r", "powers"], own)


_SPECTRUM, _SCORES = ["eigen_residual", "orthogonality_residual"], ["score_residual", "reconstruction_residual"]
ORACLE["pca_certificate"] = _certificate_sql("zlong", _SPECTRUM + _SCORES, _FULL_NEEDS, _FULL)

_ZED = """
    SELECT movieId, feature, (value - avg(value) OVER (PARTITION BY feature)) /
           CASE WHEN stddev_pop(value) OVER (PARTITION BY feature) > 1e-12 THEN stddev_pop(value) OVER (PARTITION BY feature) ELSE 1.0 END AS z
    FROM {long}"""
_GENOME = {"genome_cells": """
    SELECT s.movieId, CAST(g.tagId AS VARCHAR) AS feature, coalesce(max(CASE WHEN s.tagId = g.tagId THEN s.relevance END), 0.0) AS value
    FROM genome_scores s CROSS JOIN (SELECT DISTINCT tagId FROM genome_tags) g GROUP BY s.movieId, g.tagId""",
           "genome_z": _ZED.format(long="genome_cells")}
ORACLE["genome_pca_certificate"] = _certificate_sql("genome_z", _SPECTRUM, ["genome_scores", "genome_tags", "genome_cells", "genome_z"], _GENOME)

_TARGET = {"target_cells": _NUMERIC_CELLS, "target_full": """
    SELECT i.movieId, f.feature, coalesce(c.value, 0.0) AS value
    FROM (SELECT DISTINCT movieId FROM target_cells) i CROSS JOIN (SELECT DISTINCT feature FROM target_cells) f
    LEFT JOIN target_cells c ON c.movieId = i.movieId AND c.feature = f.feature""", "target_z": _ZED.format(long="target_full")}
ORACLE["pca_target_certificate"] = _certificate_sql("target_z", _SPECTRUM + _SCORES,
                                                    ["ratings_clean", "item_genres", "tags_clean", "target_cells", "target_full", "target_z"], _TARGET)

_GRAM = dict(_TEXT)
_GRAM["tfidf_w"] = """
    SELECT movieId, term_idx, w / sqrt(sum(w * w) OVER (PARTITION BY movieId)) AS w
    FROM (SELECT tf.movieId, v.term_idx, tf.tf * v.idf AS w FROM tf JOIN vocab v ON tf.term = v.term) x"""
_GRAM["gram_x"] = "SELECT a.term_idx AS a, b.term_idx AS b, sum(a.w * b.w) AS g FROM tfidf_w a JOIN tfidf_w b ON a.movieId = b.movieId AND a.term_idx <= b.term_idx GROUP BY a.term_idx, b.term_idx"
ORACLE["svd_certificate"] = with_ctes(f"""
SELECT v.metric, {rnd('v.value', 'value')} FROM
  (SELECT (SELECT CAST(count(*) AS DOUBLE) FROM catalog) AS items, (SELECT CAST(max(term_idx) + 1 AS DOUBLE) FROM tfidf_w) AS terms,
          (SELECT sum(w * w) FROM tfidf_w) AS norm2, (SELECT sum(CASE WHEN a = b THEN g * g ELSE 2 * g * g END) FROM gram_x) AS gram2) p,
  LATERAL (VALUES ('items', p.items), ('terms', p.terms), ('components', CASE WHEN p.terms > 1 THEN least(200.0, p.terms - 1) ELSE 1.0 END),
    ('norm2', p.norm2), ('gram_norm2', p.gram2), ('triplet_residual', 0.0), ('orthogonality_residual', 0.0),
    ('embedding_residual', 0.0), ('error_residual', 0.0)) v(metric, value)""", [*_TEXT_NEEDS, "tfidf_w", "gram_x"], _GRAM)
