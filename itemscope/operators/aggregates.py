"""Reusable aggregate building blocks.

All of them are single grouped aggregates that Spark plans as partial
(map-side) + final aggregation; none collects rows of a group anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from itemscope.functions import scalars as X


def group_count(df: DataFrame, keys: list[str] | str, name: str = "len") -> DataFrame:
    """A1: rows per key value; NULL is its own group."""
    keys = [keys] if isinstance(keys, str) else keys
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def duplicate_members(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """A10: number of rows whose key occurs more than once (all members, not
    the surplus copies). NULLs compare equal inside the key. ``keys=None``
    means the full row. One-row result, 0 on empty input."""
    keys = list(keys or df.columns)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return (per_key.filter(F.col("_n") > 1)
            .agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("duplicate_members")))


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row, ``rows`` plus the NULL count of every column, in one pass."""
    columns = list(columns or df.columns)
    return df.agg(F.count(F.lit(1)).alias("__rows__"),
                  *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def missing_long(df: DataFrame, table: str, columns: list[str] | None = None, digits: int = 4) -> DataFrame:
    """Q3 per table: (table, column, null_count, null_pct) from one aggregate."""
    columns = list(columns or df.columns)
    wide = null_counts(df, columns)
    stack = ", ".join(f"'{c}', `{c}`" for c in columns)
    long = wide.selectExpr("__rows__", f"stack({len(columns)}, {stack}) as (`column`, null_count)")
    return long.select(
        F.lit(table).alias("table"), F.col("column"),
        F.col("null_count").cast("bigint").alias("null_count"),
        X.pct(F.col("null_count"), F.col("__rows__"), digits).alias("null_pct"))


def distinct_keys(df: DataFrame, keys: list[str] | str) -> DataFrame:
    """A11."""
    keys = [keys] if isinstance(keys, str) else keys
    return df.select(*keys).distinct()


def orphan_keys(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Distinct child keys without a parent (a NULL key is an orphan).

    Distinct first, so the anti join shuffles keys, not rows; the distinct is
    pre-aggregated map-side, so a hot key costs one row per partition.
    """
    pk = parent_key or key
    parents = parent.select(F.col(pk).alias(key)).distinct()
    return child.select(key).distinct().join(parents, on=key, how="left_anti")


def coverage(child: DataFrame, parent: DataFrame, key: str, label: str,
             parent_key: str | None = None, digits: int = 4) -> DataFrame:
    """Q5 row: unmatched distinct keys and coverage percent (denominator floored at 1)."""
    pk = parent_key or key
    keys = child.select(key).distinct()
    parents = parent.select(F.col(pk).alias("__pk__")).distinct()
    # a NULL child key never matches, so it counts as unmatched
    flagged = keys.join(parents, keys[key] == parents["__pk__"], "left")
    agg = flagged.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("__pk__").isNull()).alias("u"))
    return agg.select(
        F.lit(label).alias("relationship_check"),
        F.col("u").cast("bigint").alias("unmatched_count"),
        F.round((F.lit(1.0) - F.col("u") / F.greatest(F.col("n"), F.lit(1))) * 100, digits).alias("coverage_pct"))


def with_middle(counted: DataFrame, keys: list[str], value: str, count: str) -> DataFrame:
    """``counted`` ((keys, value, count), one row a value) with ``_total``, the group's count, and ``_middle``: the value
    times how many of the two middle ranks fall on it (0, 1 or 2). A NULL value must have count 0."""
    own = Window.partitionBy(*keys)
    total = F.sum(count).over(own)
    upto = F.sum(count).over(own.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = counted.withColumn("_total", total).withColumn("_upto", upto)
    holds = lambda rank: ((rank < F.col("_upto")) & (rank >= F.col("_upto") - F.col(count))).cast("int")
    lower, upper = F.floor((F.col("_total") - 1) / 2), F.floor(F.col("_total") / 2)
    hits = holds(lower) + holds(upper)
    return ranked.withColumn("_middle", F.when(hits > 0, hits * F.col(value))).drop("_upto")


def median(df: DataFrame, value: str) -> DataFrame:
    """The exact median of a column of few distinct values: counts per value, then ranks; one row, NULL if there is none."""
    counted = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_k")).withColumn("_all", F.lit(0))
    return with_middle(counted, ["_all"], value, "_k").agg((F.sum("_middle") / 2).alias("median"))
