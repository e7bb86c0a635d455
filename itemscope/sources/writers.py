"""Sinks (S7-S10).

Everything is written in parallel by the executors, at any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, sort_by: list[str] | None = None, global_sort: bool = False,
                mode: str = "overwrite") -> None:
    """Parquet. ``sort_by`` orders rows inside every file; ``global_sort``
    adds a range-partitioned total order (one more shuffle) when readers need it."""
    out = df
    if sort_by:
        out = out.orderBy(*sort_by) if global_sort else out.sortWithinPartitions(*sort_by)
    out.write.mode(mode).parquet(path)


def write_report_csv(df: DataFrame, path: str, sort_by: list[str] | None = None, files: int | None = None) -> None:
    """A report as header CSV, written in parallel; ``sort_by`` gives a total
    order over the files. A caller that knows its report is small names the
    number of files (1)."""
    out = df.orderBy(*sort_by) if sort_by else df
    out = out.coalesce(files) if files else out
    out.write.mode("overwrite").option("header", True).csv(path)


def write_report_json(df: DataFrame, path: str) -> None:
    """Nested report (structs / lists of structs) as JSON lines."""
    df.write.mode("overwrite").json(path)


def write_report_rows(sections: dict[str, tuple[DataFrame, list[Column]]], path: str) -> None:
    """S9 for results of any length: every section becomes a folder ``path/<name>`` of JSON
    lines, one a row, in the total order given (ties by all columns). Nothing is collected into a list;
    rows are sorted by range, so no task holds a section."""
    for name, (df, order) in sections.items():
        ties = [F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})] if df.columns else []
        df.orderBy(*order, *ties).write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/{name}")


def write_sparse_matrix(weights: DataFrame, vocab: DataFrame, path: str, id_col: str) -> None:
    """Non-zero entries (id, term_idx, weight) plus the vocabulary
    (term, term_idx); unlike a bare matrix file, every row keeps its item id."""
    weights.select(id_col, "term_idx", "weight").write.mode("overwrite").parquet(f"{path}/weights")
    vocab.select("term", "term_idx").write.mode("overwrite").parquet(f"{path}/vocabulary")


def read_sparse_matrix(spark, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/weights"), spark.read.parquet(f"{path}/vocabulary")


def nest(df: DataFrame, name: str, order: list[tuple[str, bool]] | None = None) -> DataFrame:
    """One row holding all rows of a bounded result as a list of structs, sorted
    by the columns of ``order`` ((name, descending)) and then by all others: the
    list itself is sorted, so no shuffle can change its order."""
    order = order or []
    keys = [F.struct(F.col(c).isNull() if not desc else F.col(c).isNotNull(), F.col(c)).alias(f"k{i}") for i, (c, desc) in enumerate(order)]
    rest = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("all")
    row = F.struct(*keys, rest, F.struct(*df.columns).alias("row"))

    def before(x, y):
        out = F.when(x["all"] < y["all"], -1).when(x["all"] > y["all"], 1).otherwise(0)
        for i, (_, desc) in reversed(list(enumerate(order))):
            a, b = (y, x) if desc else (x, y)
            out = F.when(a[f"k{i}"] < b[f"k{i}"], -1).when(a[f"k{i}"] > b[f"k{i}"], 1).otherwise(out)
        return out

    rows = F.array_sort(F.collect_list(row), before)
    return df.agg(F.transform(rows, lambda x: x["row"]).alias(name))
