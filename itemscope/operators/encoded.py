"""Matrices whose columns are values of the data, without a collected vocabulary.

The vocabulary stays a table (feature, idx) and a row's non-zero cells become one dictionary-encoded
vector (indices, values), so the number of columns is bounded neither by the driver nor by a plan's width.
Indices follow the sorted order of the features: the distinct features are sorted by range, every
sorted part is numbered for itself, and the sizes of the parts (one number a partition) give where
each part starts. A vector holds its item's distinct features, never its raw rows.

Cells with a null feature are left out; repeated cells of an item add up; an empty table gives empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Bits of ``monotonically_increasing_id`` that number the rows of a partition.
_PLACE_BITS = 33


def vocabulary(cells: DataFrame, feature: str = "feature") -> DataFrame:
    """(feature, idx): the distinct features with gapless indices from 0, in sorted order."""
    ordered = cells.select(feature).filter(F.col(feature).isNotNull()).distinct().orderBy(feature)
    numbered = ordered.withColumn("_n", F.monotonically_increasing_id()).checkpoint() \
        .select(feature, F.shiftright("_n", _PLACE_BITS).alias("_part"), F.col("_n").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).alias("_at"))
    # one row a partition
    sizes = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    return numbered.join(starts, "_part").select(feature, (F.col("_start") + F.col("_at")).cast("int").alias("idx"))


def encoded_vectors(cells: DataFrame, vocab: DataFrame, item: str, feature: str = "feature", value: str = "value") -> DataFrame:
    """(item, indices, values): one sparse vector a row, sorted by index."""
    summed = cells.groupBy(item, feature).agg(F.sum(value).alias("_v"))
    entries = summed.join(vocab, feature).groupBy(item).agg(F.array_sort(F.collect_list(F.struct("idx", "_v"))).alias("_e"))
    return entries.select(item, F.transform("_e", lambda e: e["idx"]).alias("indices"), F.transform("_e", lambda e: e["_v"]).alias("values"))


def decoded(vectors: DataFrame, vocab: DataFrame, item: str, feature: str = "feature") -> DataFrame:
    """(item, idx, feature, value): the cells of encoded vectors."""
    cells = vectors.select(item, F.explode(F.arrays_zip("indices", "values")).alias("_e"))
    return cells.select(item, F.col("_e.indices").alias("idx"), F.col("_e.values").alias("value")).join(vocab, "idx") \
        .select(item, "idx", feature, "value")
