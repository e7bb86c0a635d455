"""Incremental cleaning and per-item rating statistics (Structured Streaming).

The reference has no streaming code; this module runs the *same* operators
(C2 cleaning, A3 statistics without the distinct-rater count, which streaming
aggregation does not support) over interaction files that keep arriving.
State is one row per item (bounded by the catalog); progress and state live
in the checkpoint folder the caller names, so a restarted query resumes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from itemscope.operators import clean as C
from itemscope.roles import DEFAULT_ROLES, RATINGS_SCHEMA, Roles


def interaction_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Interaction files as a stream, with the declared schema (no inference)."""
    reader = spark.readStream.schema(RATINGS_SCHEMA).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"')
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def rating_stats_stream(interactions: DataFrame, r: Roles = DEFAULT_ROLES) -> DataFrame:
    """C2 then per-item statistics, as a streaming aggregation."""
    clean = C.clean_interactions(interactions, r)
    return clean.groupBy(r.item).agg(
        F.count(F.lit(1)).alias("rating_count"),
        F.avg(r.score).alias("avg_rating"),
        F.stddev_samp(r.score).alias("rating_std"),
        F.min(r.score).alias("min_rating"),
        F.max(r.score).alias("max_rating"),
        F.min(r.epoch).alias("first_rating_ts"),
        F.max(r.epoch).alias("last_rating_ts"),
    )


def start_rating_stats(spark: SparkSession, source: str, target: str, checkpoint: str, name: str = "rating_stats",
                       fmt: str = "parquet", available_now: bool = True,
                       processing_time: str | None = None) -> StreamingQuery:
    """Write the statistics of all files seen in ``source`` under ``target``, one
    folder ``batch=<n>`` per micro-batch, the whole per-item table from the state
    (complete mode: bounded by the number of items); ``latest_stats`` reads the newest.

    ``checkpoint`` is a folder on shared storage that outlives the process: a
    restarted query goes on from it, and a batch that runs again writes the
    same folder again, never over an older one."""
    stats = rating_stats_stream(interaction_stream(spark, source, fmt))

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    writer = (stats.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
              .foreachBatch(write).queryName(name))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=processing_time or "1 minute")
    return writer.start()


def latest_stats(spark: SparkSession, target: str) -> DataFrame:
    """The table of the newest finished micro-batch."""
    every = spark.read.parquet(target)
    newest = every.agg(F.max("batch").alias("b")).select("b").scalar()
    return every.filter(F.col("batch") == newest).drop("batch")
