"""One scan per table for everything the profile asks of it (Q1, Q3, Q4, Q6, Q7, Q16).

A table whose key is the full row is grouped by it once. Any other goes once through GROUPING SETS: no key (row count, NULL counts, conditional counts), the key
whose repeats are counted, the column whose values are counted, and each column
whose distinct values are counted. Groups are partial aggregates before the only wide shuffle; a second
grouped aggregate reduces them to a few rows a table, ``facts``, in long form:

  (table, fact, name, bucket, value) with fact = rows | nulls | check | duplicates | bucket | distinct

The reports are joins of these few rows. Missing rows (an empty table) count as 0.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from itemscope.functions import scalars as X
from itemscope.roles import CORE_TABLES, DEFAULT_ROLES, Roles


@dataclass
class Asked:
    """What is asked of one table. ``key`` None means the full row."""

    duplicates: str
    key: list[str] | None = None
    checks: list[tuple[str, Column]] = field(default_factory=list)
    distribution: str | None = None
    distinct: tuple[str, ...] = ()


def asked(r: Roles = DEFAULT_ROLES, lo: float = 0.5, hi: float = 5.0) -> dict[str, Asked]:
    """The questions of the profile, table by table, in the order of its checks."""
    return {
        "ratings": Asked("ratings_duplicate_user_movie_pairs", [r.user, r.item],
                         [("ratings_missing_required", X.any_null([r.user, r.item, r.score, r.epoch])),
                          ("ratings_out_of_range", X.outside_range(r.score, lo, hi))], r.score, (r.user, r.item)),
        "movies": Asked("movies_duplicate_movieId", [r.item], [("movies_missing_title", F.col(r.title).isNull()),
                                                              ("movies_missing_genres", F.col(r.categories).isNull())]),
        "tags": Asked("tags_duplicate_full_rows", None, [("tags_missing_tag_text", F.col(r.tag).isNull())]),
        "links": Asked("links_duplicate_movieId", [r.item], [("links_missing_imdbId", F.col(r.imdb).isNull()),
                                                            ("links_missing_tmdbId", F.col(r.tmdb).isNull())]),
        "genome_scores": Asked("genome_scores_duplicate_movie_tag", [r.item, r.tag_id]),
        "genome_tags": Asked("genome_tags_duplicate_tagId", [r.tag_id]),
    }


def table_facts(df: DataFrame, table: str, a: Asked) -> DataFrame:
    """The facts of one table, from one scan."""
    if a.key is None and not a.distribution and not a.distinct:
        return _full_row_facts(df, table, a)
    key = list(a.key or df.columns)
    sets: list[list[str]] = [[], key]
    for one in ([a.distribution] if a.distribution else []) + list(a.distinct):
        if [one] not in sets:
            sets.append([one])
    columns = [c for c in df.columns if any(c in s for s in sets)]
    number = lambda s: sum(1 << i for i, c in enumerate(reversed(columns)) if c not in s)  # noqa: E731  its grouping_id
    of = lambda s: F.col("_g") == number(s)
    first = df.groupingSets([[F.col(c) for c in s] for s in sets], *columns).agg(
        F.grouping_id().alias("_g"), F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(c).isNull()).alias(f"_z{i}") for i, c in enumerate(df.columns)],
        *[F.count_if(cond).alias(f"_c{i}") for i, (_, cond) in enumerate(a.checks)])
    bucket = F.when(of([a.distribution]), F.col(a.distribution).cast("double")) if a.distribution else F.lit(None).cast("double")
    total = lambda c: F.sum(c).cast("bigint").alias(c)
    second = first.groupBy("_g", bucket.alias("bucket")).agg(
        total("_n"), F.count(F.lit(1)).alias("_groups"), F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).cast("bigint").alias("_dup"),
        *[total(f"_z{i}") for i in range(len(df.columns))], *[total(f"_c{i}") for i in range(len(a.checks))])
    fact = lambda kind, name, value: F.struct(F.lit(kind).alias("fact"), F.lit(name).cast("string").alias("name"), F.col(value).alias("value"))
    rows = [(of([]), [fact("rows", None, "_n"), *[fact("nulls", c, f"_z{i}") for i, c in enumerate(df.columns)],
                      *[fact("check", name, f"_c{i}") for i, (name, _) in enumerate(a.checks)]]),
            (of(key), [fact("duplicates", a.duplicates, "_dup")])]
    if a.distribution:
        rows.append((of([a.distribution]), [fact("bucket", a.distribution, "_n")]))
    rows += [(of([c]), [fact("distinct", c, "_groups")]) for c in a.distinct]
    none = F.array().cast("array<struct<fact:string,name:string,value:bigint>>")
    # a set may serve two purposes (a one-column key whose distinct values count as well)
    told = F.flatten(F.array(*[F.when(cond, F.array(*facts)).otherwise(none) for cond, facts in rows]))
    return second.select("bucket", F.explode(told).alias("f")).select(F.lit(table).alias("table"), "f.fact", "f.name", "bucket", "f.value")


def _full_row_facts(df: DataFrame, table: str, a: Asked) -> DataFrame:
    """The facts of a table whose key is the full row: its groups tell NULLs and conditions as well, so rows are
    grouped once, as they are, and not sent a second time for the counts without a key. Rows dealt by one of
    their columns meet where they are."""
    groups = df.groupBy(*[F.col(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("_n"))), F.lit(0)).cast("bigint")
    told = [("rows", None, total(F.lit(True))), *[("nulls", c, total(F.col(c).isNull())) for c in df.columns],
            *[("check", name, total(cond)) for name, cond in a.checks], ("duplicates", a.duplicates, total(F.col("_n") > 1))]
    one = groups.agg(*[value.alias(f"_v{i}") for i, (_, _, value) in enumerate(told)])
    listed = F.array(*[F.struct(F.lit(kind).alias("fact"), F.lit(name).cast("string").alias("name"), F.col(f"_v{i}").alias("value"))
                       for i, (kind, name, _) in enumerate(told)])
    return one.select(F.explode(listed).alias("f")).select(F.lit(table).alias("table"), "f.fact", "f.name",
                                                           F.lit(None).cast("double").alias("bucket"), "f.value")


def facts(tables: dict[str, DataFrame], r: Roles = DEFAULT_ROLES) -> DataFrame:
    """The facts of all tables, computed once and stored: a few rows a table and one a score."""
    from itemscope.session import ensure_checkpoint_dir
    questions = asked(r)
    parts = [table_facts(df, name, questions[name]) for name, df in tables.items()]
    whole = reduce(lambda x, y: x.unionByName(y), parts)
    ensure_checkpoint_dir(whole.sparkSession)
    return whole.checkpoint(eager=True)


def _listed(spark: SparkSession, rows: list[tuple], schema: str, known: DataFrame, on: list[str]) -> DataFrame:
    """Declared rows (schemas, names of checks) with their stored value, 0 where there is none."""
    return spark.createDataFrame(rows, schema).join(F.broadcast(known), on, "left").withColumn("value", F.coalesce("value", F.lit(0)))


def _row_counts(known: DataFrame) -> DataFrame:
    return known.filter("fact = 'rows'").select("table", F.col("value").alias("rows"))


def shapes(tables: dict[str, DataFrame], known: DataFrame, core: tuple[str, ...] = CORE_TABLES) -> DataFrame:
    """Q1: table, rows, cols, scope."""
    spark = known.sparkSession
    rows = [(n, len(df.columns), "core" if n in core else "optional") for n, df in tables.items()]
    return _listed(spark, rows, "table string, cols bigint, scope string", known.filter("fact = 'rows'").select("table", "value"), ["table"]) \
        .select("table", F.col("value").alias("rows"), "cols", "scope")


def missing(tables: dict[str, DataFrame], known: DataFrame, digits: int = 4) -> DataFrame:
    """Q3: NULL count and percent of every column."""
    rows = [(n, c) for n, df in tables.items() for c in df.columns]
    nulls = known.filter("fact = 'nulls'").select("table", F.col("name").alias("column"), "value")
    long = _listed(known.sparkSession, rows, "table string, column string", nulls, ["table", "column"])
    return long.join(F.broadcast(_row_counts(known)), "table", "left").select(
        "table", "column", F.col("value").alias("null_count"), X.pct(F.col("value"), F.coalesce("rows", F.lit(0)), digits).alias("null_pct"))


def checks(known: DataFrame, r: Roles = DEFAULT_ROLES) -> DataFrame:
    """Q4: the named checks as (check, value)."""
    rows = [(name,) for a in asked(r).values() for name in [*[n for n, _ in a.checks], a.duplicates]]
    found = known.filter("fact IN ('check', 'duplicates')").select(F.col("name").alias("check"), "value")
    return _listed(known.sparkSession, rows, "check string", found, ["check"])


def scale(known: DataFrame, r: Roles = DEFAULT_ROLES) -> DataFrame:
    """Q6: users, items, interactions, density and sparsity of the ratings, one row."""
    of = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("value"))), F.lit(0)).cast("bigint")
    distinct = F.col("fact") == "distinct"
    g = known.filter("table = 'ratings'").agg(
        of(distinct & (F.col("name") == r.user)).alias("users"), of(distinct & (F.col("name") == r.item)).alias("items"),
        of(F.col("fact") == "rows").alias("interactions"))
    possible = (F.col("users") * F.col("items")).cast("bigint")
    density = F.col("interactions") / possible
    return g.select("users", "items", "interactions", possible.alias("possible_user_item_pairs"),
                    F.when(possible > 0, F.round(density * 100, 6)).otherwise(F.lit(0.0)).alias("density_pct"),
                    F.when(possible > 0, F.round((F.lit(1.0) - density) * 100, 6)).otherwise(F.lit(0.0)).alias("sparsity_pct"))


def distribution(known: DataFrame, r: Roles = DEFAULT_ROLES) -> DataFrame:
    """Q7: rows per score."""
    return known.filter("table = 'ratings' AND fact = 'bucket'").select(F.col("bucket").alias(r.score), F.col("value").alias("len"))


def coverage(tables: dict[str, DataFrame], r: Roles = DEFAULT_ROLES, digits: int = 4) -> DataFrame:
    """Q5: unmatched distinct keys and coverage of the four relations, one narrow scan a table.

    Distinct keys of children and parents meet in one aggregate by (kind of key, key); no join is needed."""
    children = [("ratings", r.item), ("tags", r.item), ("genome_scores", r.item), ("genome_scores", r.tag_id)]
    labels = {("ratings", r.item): "ratings movieId matched in movies", ("tags", r.item): "tags movieId matched in movies",
              ("genome_scores", r.item): "genome_scores movieId matched in movies",
              ("genome_scores", r.tag_id): "genome_scores tagId matched in genome_tags"}
    by_table: dict[str, list[str]] = {"movies": [r.item], "genome_tags": [r.tag_id]}
    for table, key in children:
        by_table.setdefault(table, []).append(key)
    parts = []
    for table, keys in by_table.items():
        told = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).cast("string").alias("key")) for k in keys])).alias("k")
        parts.append(tables[table].select(told).select("k.kind", "k.key").distinct().withColumn("table", F.lit(table)))
    met = reduce(lambda x, y: x.unionByName(y), parts).groupBy("kind", "key").agg(F.collect_set("table").alias("in"))
    owner = F.when(F.col("kind") == r.item, "movies").otherwise("genome_tags")
    # a NULL key never matches
    matched = F.array_contains("in", owner) & F.col("key").isNotNull()
    counts = met.select("kind", F.explode("in").alias("table"), matched.alias("matched")).groupBy("table", "kind").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("matched")).alias("u"))
    listed = tables["movies"].sparkSession.createDataFrame([(t, k, label) for (t, k), label in labels.items()], "table string, kind string, relationship_check string")
    n, u = F.coalesce("n", F.lit(0)), F.coalesce("u", F.lit(0))
    return listed.join(F.broadcast(counts), ["table", "kind"], "left").select(
        "relationship_check", u.cast("bigint").alias("unmatched_count"),
        F.round((F.lit(1.0) - u / F.greatest(n, F.lit(1))) * 100, digits).alias("coverage_pct"))
