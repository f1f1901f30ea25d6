"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

A record's id decides its slot, one of a fixed number; the map decides the
slot's shard. Adding a shard edits the map: the new shard takes every n-th slot
of each old one and no slot moves between old shards. Rebalancing by bytes
edits it too: overfull shards release slots, which go to shards with room.
Every edit is a new version of the stored map, and old versions stay readable.

Defined cases: null text has no bytes and size 1; null ids share one slot;
rows with the same id share a slot; an empty table gives an empty result and
slots of no bytes. Other columns are never looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrain.session import new_path

SLOTS = 4096
SPREAD = 64  # parts of a slot that are numbered apart, so a hot slot is no single task


def virtual_slot(id: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(id.cast("string")), F.lit(slots)).cast("int")


def record_size(text: Column) -> Column:
    """UTF-8 bytes and one more."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def even_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """The first version: slot and shard, slots dealt in turn."""
    return spark.range(slots).select(F.col("id").cast("int").alias("virtual_slot"), (F.col("id") % shards).cast("int").alias("map_shard"))


def grown_map(slot_map: DataFrame, shards: int) -> DataFrame:
    """The map for one more shard, number ``shards``: it takes its share of every old shard's slots."""
    turn = F.row_number().over(Window.partitionBy("map_shard").orderBy("virtual_slot"))
    return slot_map.withColumn("turn", turn).select(
        "virtual_slot", F.when(F.col("turn") % (shards + 1) == 0, F.lit(shards)).otherwise(F.col("map_shard")).cast("int").alias("map_shard"))


def slot_bytes(docs: DataFrame, id: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """Rows and bytes of each slot that has any: at most ``slots`` rows."""
    return docs.groupBy(virtual_slot(F.col(id), slots).alias("virtual_slot")).agg(
        F.count(F.lit(1)).alias("slot_rows"), F.sum(record_size(F.col(text))).alias("slot_bytes"))


def rebalanced_map(slot_map: DataFrame, sizes: DataFrame, shards: int) -> DataFrame:
    """An edit that evens bytes: slots beyond a shard's fair share go to the shards with room.

    Slots of a shard keep their place in slot order until the share is filled.
    Released slots and free room are laid along one line of bytes; a slot goes
    to the shard whose room holds its middle. Works on ``slots`` rows.
    """
    known = slot_map.join(sizes.select("virtual_slot", "slot_bytes"), "virtual_slot", "left").fillna(0, ["slot_bytes"])
    everything = Window.partitionBy(F.lit(0))
    filled = F.sum("slot_bytes").over(Window.partitionBy("map_shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, 0))
    placed = known.withColumn("share", F.sum("slot_bytes").over(everything) / shards).withColumn("stays", filled <= F.col("share"))
    line = Window.partitionBy(F.lit(0)).orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, 0)
    released = placed.where(~F.col("stays")).withColumn("middle", F.sum("slot_bytes").over(line) - F.col("slot_bytes") / 2)
    old = slot_map.sparkSession.range(shards).select(F.col("id").cast("int").alias("new_shard"))
    held = placed.groupBy("map_shard").agg(F.sum(F.when(F.col("stays"), F.col("slot_bytes")).otherwise(0)).alias("kept"), F.max("share").alias("share"))
    room = old.join(held, old.new_shard == held.map_shard, "left").select(
        "new_shard", (F.coalesce("share", F.max("share").over(everything)) - F.coalesce("kept", F.lit(0))).alias("free"))
    upto = Window.partitionBy(F.lit(0)).orderBy("new_shard").rowsBetween(Window.unboundedPreceding, 0)
    spans = room.withColumn("upper", F.sum("free").over(upto)).withColumn("lower", F.col("upper") - F.col("free")).where("free > 0")
    moved = released.join(F.broadcast(spans), (F.col("middle") > F.col("lower")) & (F.col("middle") <= F.col("upper")), "left")
    return placed.where("stays").select("virtual_slot", "map_shard").unionByName(
        moved.select("virtual_slot", F.coalesce("new_shard", "map_shard").cast("int").alias("map_shard")))


def store_map(slot_map: DataFrame, path: str, version: int) -> str:
    """Writes one version of the map; earlier versions stay."""
    slot_map.withColumn("version", F.lit(version)).coalesce(1).write.mode("append").partitionBy("version").parquet(path)
    return path


def read_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    schema = "virtual_slot int, map_shard int, version int"
    return spark.read.schema(schema).parquet(path).where(F.col("version") == version).select("virtual_slot", "map_shard")


def assign(docs: DataFrame, slot_map: DataFrame, id: str = "doc_id", slots: int = SLOTS, shard: str = "shard") -> DataFrame:
    """Adds the slot and its shard. The map has ``slots`` rows, so it is broadcast."""
    keyed = docs.withColumn("virtual_slot", virtual_slot(F.col(id), slots))
    return keyed.join(F.broadcast(slot_map.withColumnRenamed("map_shard", shard)), "virtual_slot", "left")


def number_in_shard(rows: DataFrame, order: list[Column], spread: Column) -> DataFrame:
    """Adds ``slot``: the row's place in its shard, gapless from 0.

    Rows are numbered within parts of a virtual slot, and each part starts
    where the earlier parts of its shard end. The table of part sizes has at
    most SLOTS x SPREAD rows whatever the input.
    """
    parted = rows.withColumn("_part", F.pmod(spread, F.lit(SPREAD)).cast("int"))
    sizes = parted.groupBy("shard", "virtual_slot", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("virtual_slot", "_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("virtual_slot").alias("_vs"), F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    local = F.row_number().over(Window.partitionBy("virtual_slot", "_part").orderBy(*order))
    numbered = parted.withColumn("_local", local)
    joined = numbered.join(starts, (F.col("virtual_slot") == F.col("_vs")) & (F.col("_part") == F.col("_p")))
    return joined.withColumn("slot", (F.col("_start") + F.col("_local") - 1).cast("long")).drop("_vs", "_p", "_start", "_local", "_part")


def shard_documents(docs: DataFrame, path: str, shards: int = 8, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with its shard now, its place there, and its shard after growing by one.

    The maps are read from ``path``, versions 1 and 2; they depend on the
    number of shards alone, so the id and that number decide the shard.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id), record_size(F.col(text)).alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"))
    now = assign(rows, read_map(spark, path, 1), id)
    both = assign(now.drop("virtual_slot"), read_map(spark, path, 2), id, shard="grown_shard")
    numbered = number_in_shard(both, [F.col(id), F.col("text_crc32"), F.col("size")], F.xxhash64(F.lit("part"), F.col(id), F.col("text_crc32")))
    return numbered.select(id, "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard", "virtual_slot")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "slot-map")
    first = even_map(spark, 8)
    store_map(first, path, 1)
    store_map(grown_map(first, 8), path, 2)
    return shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
