"""Readers and input checks.

Schemas are always declared; nothing is inferred from a sample. Existence
and size checks ask the file system (metadata), they read no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV with a declared schema. ``escape='"'`` keeps a doubled
    quote inside a quoted field; quoted and unquoted empties read as NULL.
    Rows that do not parse keep NULLs (PERMISSIVE), the cleaners drop them."""
    return (spark.read.schema(schema).option("header", True).option("escape", '"')
            .option("mode", "PERMISSIVE").csv(path))


def read_csv_text(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """S1 for raw files whose cells must be cast leniently later (all strings)."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return read_csv(spark, path, schema)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table; a missing path raises (PATH_NOT_FOUND)."""
    return spark.read.parquet(path)


def sample_rows(df: DataFrame, n: int) -> DataFrame:
    """S3: a bounded peek (the limit is the feature)."""
    return df.limit(n)


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def missing_paths(spark: SparkSession, paths: dict[str, str]) -> list[str]:
    """Names of the inputs whose path does not exist (metadata calls only)."""
    out = []
    for name, path in paths.items():
        fs, p = _fs_path(spark, path)
        if not fs.exists(p):
            out.append(f"{name}: {path}")
    return out


def preflight(spark: SparkSession, paths: dict[str, str]) -> None:
    """Fail once, naming every missing input (not just the first)."""
    missing = missing_paths(spark, paths)
    if missing:
        raise FileNotFoundError("Missing expected tables: " + ", ".join(missing))


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that the caller itself wrote; a missing one is no error."""
    fs, p = _fs_path(spark, path)
    fs.delete(p, True)


def path_size_bytes(spark: SparkSession, path: str) -> int:
    """Total bytes under a file or folder (file-system metadata)."""
    fs, p = _fs_path(spark, path)
    return int(fs.getContentSummary(p).getLength())


def input_sizes(spark: SparkSession, sources: dict[str, list[str]]) -> DataFrame:
    """Size of each logical input in MB (round(bytes / 1024^2, 2)); an input
    made of several stored tables counts all of them."""
    rows = [(name, float(sum(path_size_bytes(spark, p) for p in paths))) for name, paths in sources.items()]
    df = spark.createDataFrame(rows, "table string, bytes double")
    return df.select("table", F.round(F.col("bytes") / F.lit(1024.0 ** 2), 2).alias("size_mb"))


def file_sizes(df: DataFrame) -> DataFrame:
    """S6 for a file-based DataFrame: its files and their sizes from ``_metadata``."""
    return df.select(F.col("_metadata.file_path").alias("file_path"),
                     F.col("_metadata.file_size").alias("file_size")).distinct()
