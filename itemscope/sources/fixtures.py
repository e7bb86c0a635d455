"""The driver's TPC-H-ish tables seen in the catalog roles.

Each role is defined twice from the same rule: as a DataFrame (what the
library runs) and as a DuckDB CTE (what the independent SQL oracle runs).
Every role reads whole tables and whole texts.

Roles:
  ratings        lineitem joined to orders: customer rates part, quantity/10
  movies         part: name (+ year from p_size) and bar-joined genre words
  links          supplier: nation key as external ids
  tags           documents: every whitespace word of the text is a tag event
  tags_events    events: event_type as a small-vocabulary tag
  genome_scores  embeddings exploded to (vector id, position, value)
  genome_tags    the distinct positions of genome_scores
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture rule.
SENTINEL_GENRE = "(no genres listed)"
PROMO_TYPE = "PROMO"
YEAR_BASE = 1950
NO_YEAR_SIZE_MODULUS = 10
TAG_USER_MODULUS = 150
TAG_SECONDS_PER_DOC = 3600
# A word is a maximal run of characters outside ASCII whitespace; the same
# class is spelled for Java regex (Spark) and RE2 (DuckDB).
WORD_PATTERN = r"[^ \t\n\x0B\f\r]+"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_before_explode(df: DataFrame, key: str) -> DataFrame:
    """Deal the rows over the shuffle partitions by ``key`` in front of a
    row-multiplying generator: whatever the file layout, no task explodes more
    than its share. The count is explicit, so adaptive execution does not merge
    partitions whose size says nothing about the rows they will make."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, key)


def epoch_seconds(col: str | Column) -> Column:
    """Whole epoch seconds of a timestamp_ntz (floor), independent of time zone."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(od, li.l_orderkey == od.o_orderkey, "inner").select(
        F.col("o_custkey").cast("bigint").alias("userId"),
        F.col("l_partkey").cast("bigint").alias("movieId"),
        (F.col("l_quantity") / F.lit(10)).cast("double").alias("rating"),
        epoch_seconds("o_orderdate").cast("bigint").alias("timestamp"),
    )


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size")
    year = (F.lit(YEAR_BASE) + F.col("p_size")).cast("string")
    title = F.when(F.col("p_size") % NO_YEAR_SIZE_MODULUS == 0, F.col("p_name")) \
        .otherwise(F.concat(F.col("p_name"), F.lit(" ("), year, F.lit(")")))
    genres = F.when(F.col("p_type") == PROMO_TYPE, F.lit(SENTINEL_GENRE)).otherwise(
        F.concat(F.regexp_replace("p_name", F.lit(" "), F.lit("|")), F.lit("|"), F.col("p_type")))
    return p.select(F.col("p_partkey").cast("bigint").alias("movieId"),
                    title.alias("title"), genres.alias("genres"))


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return s.select(
        F.col("s_suppkey").cast("bigint").alias("movieId"),
        F.col("s_nationkey").cast("bigint").alias("imdbId"),
        F.nullif(F.col("s_nationkey"), F.lit(0)).cast("bigint").alias("tmdbId"),
    )


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = spread_before_explode(_read(spark, sf_dir, "documents").select("doc_id", "n_chars", "text"), "doc_id")
    words = d.select(
        "doc_id", "n_chars",
        F.posexplode(F.regexp_extract_all(F.col("text"), F.lit(WORD_PATTERN), F.lit(0))).alias("pos", "tag"),
    )
    return words.select(
        (F.col("n_chars") % TAG_USER_MODULUS).cast("bigint").alias("userId"),
        F.col("doc_id").cast("bigint").alias("movieId"),
        F.col("tag"),
        (F.col("doc_id") * TAG_SECONDS_PER_DOC + F.col("pos")).cast("bigint").alias("timestamp"),
    )


def tags_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "events").select("ts", "user_id", "event_type", "props")
    return e.select(
        F.col("user_id").cast("bigint").alias("userId"),
        F.get_json_object("props", "$.k").cast("bigint").alias("movieId"),
        F.col("event_type").alias("tag"),
        epoch_seconds("ts").cast("bigint").alias("timestamp"),
    )


def genome_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return e.select("vec_id", F.posexplode("embedding").alias("pos", "value")).select(
        F.col("vec_id").cast("bigint").alias("movieId"),
        F.col("pos").cast("bigint").alias("tagId"),
        F.col("value").cast("double").alias("relevance"),
    )


def genome_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genome_scores(spark, sf_dir).select("tagId").distinct().select(
        "tagId", F.concat(F.lit("dim_"), F.lpad(F.col("tagId").cast("string"), 2, "0")).alias("tag"))


ROLE_BUILDERS = {
    "movies": movies,
    "ratings": ratings,
    "tags": tags,
    "links": links,
    "genome_scores": genome_scores,
    "genome_tags": genome_tags,
}


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: build(spark, sf_dir) for name, build in ROLE_BUILDERS.items()}


# --- the same roles as DuckDB CTEs (oracle side) --------------------------

SQL_ROLES = {
    "ratings": """
    SELECT CAST(o.o_custkey AS BIGINT) AS userId, CAST(l.l_partkey AS BIGINT) AS movieId,
           CAST(l.l_quantity / 10 AS DOUBLE) AS rating,
           CAST(epoch_us(o.o_orderdate) // 1000000 AS BIGINT) AS "timestamp"
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "movies": f"""
    SELECT CAST(p_partkey AS BIGINT) AS movieId,
           CASE WHEN p_size % {NO_YEAR_SIZE_MODULUS} = 0 THEN p_name
                ELSE p_name || ' (' || CAST({YEAR_BASE} + p_size AS VARCHAR) || ')' END AS title,
           CASE WHEN p_type = '{PROMO_TYPE}' THEN '{SENTINEL_GENRE}'
                ELSE replace(p_name, ' ', '|') || '|' || p_type END AS genres
    FROM part""",
    "links": """
    SELECT CAST(s_suppkey AS BIGINT) AS movieId, CAST(s_nationkey AS BIGINT) AS imdbId,
           CAST(nullif(s_nationkey, 0) AS BIGINT) AS tmdbId
    FROM supplier""",
    "tags": f"""
    SELECT CAST(n_chars % {TAG_USER_MODULUS} AS BIGINT) AS userId, CAST(doc_id AS BIGINT) AS movieId,
           w.tag AS tag, CAST(doc_id * {TAG_SECONDS_PER_DOC} + w.pos - 1 AS BIGINT) AS "timestamp"
    FROM documents d,
         LATERAL (SELECT unnest(regexp_extract_all(d.text, '{WORD_PATTERN}')) AS tag,
                         unnest(range(1, len(regexp_extract_all(d.text, '{WORD_PATTERN}')) + 1)) AS pos) w""",
    "tags_events": """
    SELECT CAST(user_id AS BIGINT) AS userId, CAST(json_extract_string(props, '$.k') AS BIGINT) AS movieId,
           event_type AS tag, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS "timestamp"
    FROM events""",
    "genome_scores": """
    SELECT CAST(vec_id AS BIGINT) AS movieId, CAST(g.pos - 1 AS BIGINT) AS tagId,
           CAST(g.value AS DOUBLE) AS relevance
    FROM embeddings e,
         LATERAL (SELECT unnest(e.embedding) AS value,
                         unnest(range(1, len(e.embedding) + 1)) AS pos) g""",
}
SQL_ROLES["genome_tags"] = """
    SELECT DISTINCT tagId, 'dim_' || lpad(CAST(tagId AS VARCHAR), 2, '0') AS tag FROM genome_scores"""

_SQL_ORDER = ["ratings", "movies", "links", "tags", "tags_events", "genome_scores", "genome_tags"]


def sql_with(body: str, roles: list[str] | None = None) -> str:
    """Prefix ``body`` (which may start with its own CTEs via ``, x AS (...)``)
    with the role CTEs it needs."""
    wanted = _SQL_ORDER if roles is None else [r for r in _SQL_ORDER if r in roles]
    if "genome_tags" in wanted and "genome_scores" not in wanted:
        wanted.insert(wanted.index("genome_tags"), "genome_scores")
    ctes = ",\n".join(f"{name} AS ({SQL_ROLES[name]})" for name in wanted)
    return f"WITH {ctes}\n{body}"


# Stored tables behind every role (for input sizes).
ROLE_SOURCES = {
    "movies": ["part"],
    "ratings": ["lineitem", "orders"],
    "tags": ["documents"],
    "links": ["supplier"],
    "genome_scores": ["embeddings"],
    "genome_tags": ["embeddings"],
}


def role_source_paths(sf_dir: str) -> dict[str, list[str]]:
    return {role: [f"{sf_dir}/{t}.parquet" for t in tables] for role, tables in ROLE_SOURCES.items()}
