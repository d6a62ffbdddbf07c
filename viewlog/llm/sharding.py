"""Operator 5, sharding by fixed virtual slots (DataFrame functions only).

Every record is hashed into one of ``slots`` virtual slots. One partial
aggregate gives the bytes and rows of each slot, and a versioned map assigns
slots to shards. Version 1 deals the slots out in turn; a rebalancing step adds
a version whose entries are edited so that shards hold nearly equal bytes. Only
the map (one row per slot, a fixed number) is handled whole; records move only
with their slot.

Defined results: a null text has size 1 and the crc32 of the empty string; a
null ``doc_id`` hashes as its own value; identical repeated rows are each
placed; an empty table gives an empty result; other columns of the input are
ignored. A single slot is never split, so one record larger than a shard's
share stays whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Virtual slots: thousands, so that each is a small part of a shard.
SLOTS = 4096
SHARDS = 8


def slot_of(slots: int = SLOTS) -> Column:
    """The virtual slot of a record, from its id and the checksum of its text."""
    return F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(slots)).cast("int")


def sized(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size (UTF-8 bytes + 1), text_crc32, virtual slot; no text."""
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    base = docs.select("doc_id", (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return base.withColumn("vslot", slot_of(slots))


def slot_bytes(records: DataFrame) -> DataFrame:
    """Bytes and rows of each slot: partial sums before the shuffle, so no hot group moves."""
    return records.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n_rows"))


def initial_map(spark: SparkSession, slots: int = SLOTS, shards: int = SHARDS) -> DataFrame:
    """Version 1: slots dealt out in turn."""
    return spark.range(slots).select(
        F.lit(1).alias("version"), F.col("id").cast("int").alias("vslot"), F.pmod("id", F.lit(shards)).cast("int").alias("shard")
    )


def rebalance(slot_map: DataFrame, loads: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The next version of the map, by bytes: largest slot first, to the shard with fewest bytes.

    A slot goes back to its present shard where that is one of the emptiest, so
    ties move nothing. The loop over the map's fixed number of slots is one
    ``aggregate`` expression.
    """
    slot = slot_map.join(loads.select("vslot", "bytes"), "vslot", "left").select(
        "version", "vslot", "shard", F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes")
    )
    whole = slot.agg(
        (F.max("version") + 1).alias("version"),
        F.sort_array(F.collect_list(F.struct((-F.col("bytes")).alias("neg"), "vslot", "shard"))).alias("slots"),
    )
    step = """
        aggregate(
          slots,
          named_struct('loads', array_repeat(0L, {n}), 'to', cast(array() as array<int>)),
          (s, x) -> named_struct(
            'loads', transform(s.loads, (b, i) -> if(i = {pick}, b - x.neg, b)),
            'to', concat(s.to, array({pick}))))
    """
    pick = "if(get(s.loads, x.shard) = array_min(s.loads), x.shard, cast(array_position(s.loads, array_min(s.loads)) as int) - 1)"
    dealt = whole.select("version", "slots", F.expr(step.format(n=shards, pick=pick)).alias("r"))
    zipped = dealt.select("version", F.explode(F.arrays_zip("slots", F.col("r.to").alias("to"))).alias("z"))
    return zipped.select("version", F.col("z.slots.vslot").alias("vslot"), F.col("z.to").cast("int").alias("shard"))


def save_map(slot_map: DataFrame, path: str, version: int) -> None:
    """Store one version of the map in a folder of its own; a rerun replaces just that version."""
    slot_map.select("vslot", "shard").coalesce(1).write.mode("overwrite").parquet(f"{path}/version={version}")


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of the stored map; the latest by default."""
    stored = spark.read.schema("vslot int, shard int, version int").parquet(path)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    return stored.where(F.col("version") == version).select("version", "vslot", "shard")


def place(records: DataFrame, slot_map: DataFrame, loads: DataFrame) -> DataFrame:
    """Shard of each record and its place there, gapless from 0.

    A record's place is the number of rows in earlier slots of its shard (a
    prefix sum over the map) plus its number within its slot, so records are
    shuffled by slot and never by shard.
    """
    whole = slot_map.join(loads, "vslot", "left")
    before = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = whole.select(
        "version", "vslot", "shard", F.coalesce(F.sum(F.coalesce("n_rows", F.lit(0))).over(before), F.lit(0)).alias("slot_offset")
    )
    in_slot = Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size")
    numbered = records.withColumn("in_slot", F.row_number().over(in_slot) - 1)
    # The map has a fixed number of rows (one per virtual slot), whatever the input's size.
    return numbered.join(F.broadcast(offsets), "vslot").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("slot_offset") + F.col("in_slot")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("vslot").alias("virtual_slot"),
        F.col("version").alias("map_version"),
    )


def shard(docs: DataFrame, map_path: str, slots: int = SLOTS, shards: int = SHARDS) -> DataFrame:
    """Place all records under the rebalanced map, storing both map versions at ``map_path``."""
    spark = docs.sparkSession
    records = sized(docs, slots)
    loads = slot_bytes(records)
    first = initial_map(spark, slots, shards)
    save_map(first, map_path, 1)
    save_map(rebalance(load_map(spark, map_path, 1), loads, shards), map_path, 2)
    return place(records, load_map(spark, map_path), loads)
