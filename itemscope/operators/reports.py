"""Nested reports (Q15, Q16, Q18): one-row DataFrames of lists of structs,
built from bounded profile results and written with ``write_report_json``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from itemscope.sources.writers import nest

# The table usage recommendation of the profile report.
TABLE_USAGE = [
    ("ratings", "required", "primary interaction layer and sparsity analysis"),
    ("movies", "required", "catalog layer and metadata base"),
    ("tags", "recommended", "text signal for future content and hybrid features"),
    ("links", "recommended", "external IDs and integration hooks"),
    ("genome_scores", "optional", "large feature source for week5+, can be deferred"),
    ("genome_tags", "optional", "lookup table for genome_scores tags"),
]

def table_usage(spark: SparkSession) -> DataFrame:
    """Q18."""
    return spark.createDataFrame(TABLE_USAGE, "table string, week3_use string, reason string")


def _one_row(parts: list[DataFrame]) -> DataFrame:
    """One row holding every column of the one-row ``parts`` (scalar subqueries)."""
    spark = parts[0].sparkSession
    return spark.range(1).select(*[p.select(c).scalar().alias(c) for p in parts for c in p.columns])


def profile_report(spark: SparkSession, shapes: DataFrame, missing_nonzero: DataFrame, checks: DataFrame,
                   coverage: DataFrame, scale: DataFrame, memory: DataFrame, distribution: DataFrame,
                   top_categories: DataFrame) -> DataFrame:
    """Q16: the profile summary with the key names of the reference's report."""
    check_map = checks.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("check", "value")))).alias("quality_checks"))
    return _one_row([
        nest(shapes, "table_shapes", [("rows", True)]),
        nest(table_usage(spark), "recommended_table_usage"),
        nest(missing_nonzero, "missing_columns_nonzero", [("table", True), ("null_count", True)]),
        check_map,
        nest(coverage, "join_coverage"),
        scale.select(F.struct(*scale.columns).alias("scale_metrics")),
        nest(memory, "table_memory_estimate_mb", [("size_mb", True)]),
        nest(distribution, "rating_distribution", [(distribution.columns[0], False)]),
        nest(top_categories, "top_genres", [("len", True)]),
    ])


def profile_sections(shapes: DataFrame, missing_nonzero: DataFrame, checks: DataFrame, coverage: DataFrame, scale: DataFrame,
                     distribution: DataFrame, top_categories: DataFrame) -> dict[str, tuple[DataFrame, list[Column]]]:
    """Q16 for ``write_report_rows``: the same results as rows, for scores with any number of values."""
    return {
        "table_shapes": (shapes, [F.desc("rows")]),
        "recommended_table_usage": (table_usage(shapes.sparkSession), []),
        "missing_columns_nonzero": (missing_nonzero, [F.desc("table"), F.desc("null_count")]),
        "quality_checks": (checks, [F.asc("check")]),
        "join_coverage": (coverage, []),
        "scale_metrics": (scale, []),
        "rating_distribution": (distribution, [F.asc(distribution.columns[0])]),
        "top_genres": (top_categories, [F.desc("len")]),
    }


def cleaning_report(spark: SparkSession, inputs: DataFrame, row_changes: DataFrame, join_checks: DataFrame,
                    outputs: list[str], decisions: list[str] = ()) -> DataFrame:
    """Q15: inputs, row changes, join checks, and what the caller says it
    decided and wrote."""
    lits = spark.createDataFrame([(list(decisions), list(outputs))], "key_decisions array<string>, output_tables array<string>")
    return _one_row([
        nest(inputs, "input_tables"),
        nest(row_changes, "row_changes"),
        nest(join_checks, "join_checks"),
        lits,
    ])
