"""Sharding through fixed virtual slots (DataFrame functions only).

A record's key is hashed into one of thousands of slots; a versioned map says
which shard owns a slot. The number of slots never changes, so a record's slot
is final: growing or rebalancing edits the map, and only the records of the
edited slots move. The byte load of every slot is aggregated, and
``rebalanced`` edits the map by it.

Plan: rows are reduced to (slot, key, size, crc) and counted, so repeated rows
meet as one; a slot's entries are numbered in ``PARTS`` parts by content, so a key that
holds a third of all rows is numbered by many tasks. Copies are written out from their count, in stretches of
at most ``STRETCH`` that spread over tasks where there are more. Slot loads and maps have SLOTS rows, whatever the input.

Defined results: a null text has size 1 and the checksum of no bytes; rows
with a null key are placed by (size, checksum); equal rows get distinct places;
texts of any length are only measured; other columns are ignored, whatever their names; an empty table gives no rows, and a map does not depend on the data unless
``rebalanced`` is asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SLOTS = 8192
#: Parts of a slot that are numbered apart; copies of a row that one task writes out.
PARTS, STRETCH = 256, 1 << 16


def first_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """(version, slot, shard): the map of one shard, grown one by one to ``shards``."""
    m = spark.range(slots).select(F.lit(1).alias("version"), F.col("id").cast("int").alias("slot"), F.lit(0).alias("shard"))
    for n in range(1, shards):
        m = grown(m, n)
    return m


def grown(slot_map: DataFrame, shards: int) -> DataFrame:
    """The next version: one more shard takes slots out of the present ones, into itself only.

    Every shard gives the slots whose rank under a hash of (slot, new shard)
    is among its first 1/(shards + 1): the choice depends on slot and shard
    numbers alone."""
    order = Window.partitionBy("shard").orderBy(F.xxhash64("slot", F.lit(shards)), "slot")
    size = F.count(F.lit(1)).over(Window.partitionBy("shard"))
    ranked = slot_map.withColumn("_r", F.row_number().over(order)).withColumn("_n", size)
    moves = F.col("_r") * F.lit(shards + 1) <= F.col("_n")
    return ranked.select((F.col("version") + 1).alias("version"), "slot",
                         F.when(moves, F.lit(shards)).otherwise(F.col("shard")).alias("shard"))


def slot_loads(entries: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(slot, records, bytes) of every slot, empty ones included."""
    loads = entries.groupBy("slot").agg(F.sum("copies").alias("records"), F.sum(F.col("copies") * F.col("size")).alias("bytes"))
    every = entries.sparkSession.range(slots).select(F.col("id").cast("int").alias("slot"))
    return every.join(loads, "slot", "left").select("slot", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("records", "bytes")])


def rebalanced(slot_map: DataFrame, loads: DataFrame, shards: int) -> DataFrame:
    """The next version, edited by bytes: shards above the mean give slots, shards below take them.

    Within a shard, slots are laid end to end in descending load. What
    sticks out beyond the mean is offered; offers and room are laid on one axis
    each, and an offered slot goes to the shard whose room its start falls
    into. All frames here have ``SLOTS`` or ``shards`` rows."""
    mean = loads.agg((F.sum("bytes") / F.lit(shards)).alias("m")).select("m").scalar()
    m = slot_map.join(loads, "slot")
    end = F.sum("bytes").over(Window.partitionBy("shard").orderBy(F.desc("bytes"), "slot").rowsBetween(Window.unboundedPreceding, 0))
    m = m.withColumn("_end", end).withColumn("_offer", (F.col("_end") > mean) & (F.col("bytes") > 0))
    kept = m.groupBy("shard").agg(F.sum(F.when(~F.col("_offer"), F.col("bytes")).otherwise(0)).alias("kept"))
    every = slot_map.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"))
    room = every.join(kept, "shard", "left").select(F.col("shard").alias("to"), F.greatest(F.lit(0.0), mean - F.coalesce("kept", F.lit(0))).alias("room"))
    before = lambda order: Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    starts = room.select(F.coalesce(F.sum("room").over(before(["to"])), F.lit(0.0)).alias("at"), "room", "to").filter("room > 0")
    offers = m.filter("_offer").select(
        F.coalesce(F.sum("bytes").over(before([F.desc("bytes"), "slot"])), F.lit(0)).cast("double").alias("at"), "slot", "shard")
    axis = starts.select("at", "to", F.lit(None).cast("int").alias("slot")).unionByName(
        offers.select("at", F.lit(None).cast("int").alias("to"), "slot"))
    owner = F.last("to", ignorenulls=True).over(Window.orderBy("at", F.col("slot").isNotNull(), "slot").rowsBetween(Window.unboundedPreceding, 0))
    edits = axis.select("slot", owner.alias("_to")).filter("slot is not null")
    return slot_map.join(edits, "slot", "left").select((F.col("version") + 1).alias("version"), "slot",
                                                       F.coalesce("_to", "shard").cast("int").alias("shard"))


def save_map(slot_map: DataFrame, path: str) -> None:
    """Add a version to the stored maps; versions are immutable."""
    slot_map.coalesce(1).write.mode("append").partitionBy("version").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One stored version of the map, the latest by default."""
    maps = spark.read.parquet(path).select(F.col("version").cast("int").alias("version"), "slot", "shard")
    wanted = F.lit(version) if version is not None else maps.agg(F.max("version").alias("v")).select("v").scalar()
    return maps.filter(F.col("version") == wanted)


def slot_of(key: str | Column, fallback: Column, slots: int = SLOTS) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    h = F.when(k.isNotNull(), F.xxhash64(k)).otherwise(fallback)
    return F.pmod(h, F.lit(slots)).cast("int")


def entries(docs: DataFrame, key: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """(slot, key, size, text_crc32, copies): equal rows counted together."""
    data = F.encode(F.coalesce(F.col(text).cast("string"), F.lit("")), "UTF-8")
    rows = docs.select(F.col(key).alias("key"), (F.octet_length(data) + 1).cast("bigint").alias("size"),
                       F.crc32(data).alias("text_crc32"))
    slot = slot_of("key", F.xxhash64("size", "text_crc32"), slots)
    return rows.groupBy(slot.alias("slot"), "key", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies"))


def place(items: DataFrame, slot_map: DataFrame, grown_map: DataFrame, loads: DataFrame | None = None, stretch: int = STRETCH) -> DataFrame:
    """Every record's shard and its place there, gapless from 0; with ``loads`` also the bytes of its virtual slot.

    A part of a slot starts where the slots and parts before it in its shard end; inside a part
    entries are ordered by (key, size, checksum), copies of a row side by side."""
    items = items.withColumn("_part", F.pmod(F.xxhash64("size", "text_crc32", F.lit(3)), F.lit(PARTS)).cast("int"))
    held = items.groupBy("slot", "_part").agg(F.sum("copies").alias("records"))
    before = Window.partitionBy("shard").orderBy("slot", "_part").rowsBetween(Window.unboundedPreceding, -1)
    known = slot_map.join(grown_map.select("slot", F.col("shard").alias("grown_shard")), "slot")
    if loads is not None:
        known = known.join(loads.select("slot", F.col("bytes").alias("slot_bytes")), "slot")
    starts = held.join(F.broadcast(known), "slot").withColumn("_start", F.coalesce(F.sum("records").over(before), F.lit(0))).drop("records")
    inside = Window.partitionBy("slot", "_part").orderBy("key", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    rows = items.withColumn("_before", F.coalesce(F.sum("copies").over(inside), F.lit(0))).join(starts, ["slot", "_part"])
    rows = rows.withColumn("_first", F.col("_start") + F.col("_before")).withColumn("_end", F.col("_first") + F.col("copies"))
    few = rows.filter(F.col("copies") <= stretch)
    cuts = rows.filter(F.col("copies") > stretch).withColumn(
        "_first", F.explode(F.sequence(F.col("_first"), F.col("_end") - 1, F.lit(stretch).cast("bigint"))))
    many = cuts.withColumn("_end", F.least(F.col("_end"), F.col("_first") + stretch)).repartition("slot", "_first")
    extra = ["slot_bytes"] if loads is not None else []
    return few.unionByName(many).select(
        "key", "size", "text_crc32", "shard", F.explode(F.sequence(F.col("_first"), F.col("_end") - 1)).alias("place"), "grown_shard",
        F.col("slot").alias("virtual_slot"), F.col("version").alias("map_version"), *extra).withColumnRenamed("place", "slot")
