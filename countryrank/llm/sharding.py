"""Sharding by fixed virtual slots.

Records hash into SLOTS slots. Bytes are summed per slot, and a versioned map sends every slot to a shard. Rebalancing
edits the map; a record never changes its slot. The law of the map is `bytes`: shards hold nearly equal sizes.

Null texts have no bytes and size 1; null ids hash by their size and checksum. Equal rows are interchangeable and each
gets its own place. Groups of equal texts aren't kept together: a group may hold more bytes than a shard, so its records
hash by their ids and spread over all shards alike. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shared_dir

SLOTS = 4096
SHARDS = 16


def sized(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """id, size in bytes plus 1, unsigned crc32 of the text and the virtual slot."""
    data = F.coalesce(F.col(text_col), F.lit(""))
    out = df.select(F.col(id_col), (F.octet_length(data) + 1).cast("bigint").alias("size"), F.crc32(F.encode(data, "UTF-8")).cast("bigint").alias("text_crc32"))
    key = F.when(F.col(id_col).isNull(), F.xxhash64("size", "text_crc32")).otherwise(F.xxhash64(id_col))
    return out.withColumn("virtual_slot", F.pmod(key, F.lit(slots)).cast("int"))


def slot_stats(records: DataFrame) -> DataFrame:
    """Rows and bytes of each slot: at most SLOTS rows, summed before the shuffle."""
    return records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))


def slot_map(stats: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Version 1 of the map: slots from the largest to the smallest, each to the shard with the fewest bytes so far.

    The fold runs over one row that holds the list of slots, which SLOTS bounds whatever the input.
    """
    ordered = stats.groupBy().agg(F.reverse(F.array_sort(F.collect_list(F.struct("bytes", "virtual_slot", "rows")))).alias("s"))
    zero = F.struct(F.array_repeat(F.lit(0).cast("bigint"), shards).alias("load"), F.array().cast("array<int>").alias("to"))

    def step(acc: Column, x: Column) -> Column:
        least = F.array_position(acc["load"], F.array_min(acc["load"])).cast("int") - 1
        return F.struct(F.transform(acc["load"], lambda v, i: F.when(i == least, v + x["bytes"]).otherwise(v)).alias("load"), F.concat(acc["to"], F.array(least)).alias("to"))

    folded = ordered.select("s", F.aggregate("s", zero, step, lambda a: a["to"]).alias("to"))
    rows = folded.select(F.explode(F.arrays_zip("s", "to")).alias("x"))
    return rows.select("x.s.virtual_slot", F.col("x.to").cast("int").alias("shard"), "x.s.bytes", "x.s.rows", F.lit(1).alias("map_version"))


def store_map(mapping: DataFrame, path: str) -> None:
    """Stores a version of a map beside the others. A version that is stored again, as by a driver that runs anew, replaces
    itself and leaves the others alone, so no slot is in a version twice."""
    mapping.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("map_version").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A stored version of a map, the newest by default. A map has at most SLOTS rows."""
    stored = spark.read.schema("virtual_slot int, shard int, bytes long, rows long, map_version int").parquet(path)
    if version is None:
        version = stored.agg(F.max("map_version")).first()[0]
    return stored.filter(F.col("map_version") == version)


def rebalance(spark: SparkSession, path: str, to_shards: int) -> DataFrame:
    """Edits the newest stored map for more shards, stores it as the next version and returns it."""
    newest = load_map(spark, path)
    store_map(grow_map(newest, to_shards), path)
    return load_map(spark, path)


def grow_map(current: DataFrame, to_shards: int) -> DataFrame:
    """The next version of a map with more shards: each old shard gives its last slots until its bytes fit the new share.

    Rows move into new shards only. The slots that move are dealt to the new shards by size in turn.
    """
    old = current.agg(F.max("shard")).first()[0] + 1
    if to_shards <= old:
        return current.withColumn("map_version", F.col("map_version") + 1)
    within = Window.partitionBy("shard").orderBy("virtual_slot")
    share = F.sum("bytes").over(Window.partitionBy("shard")) * old / F.lit(to_shards)
    marked = current.withColumn("moves", F.sum("bytes").over(within.rowsBetween(Window.unboundedPreceding, 0)) > share)
    deal = F.row_number().over(Window.partitionBy("moves").orderBy(F.desc("bytes"), "virtual_slot")) - 1
    new = F.lit(old) + F.pmod(deal, F.lit(to_shards - old))
    return marked.withColumn("shard", F.when(F.col("moves"), new).otherwise(F.col("shard")).cast("int")).drop("moves").withColumn("map_version", F.col("map_version") + 1)


def place(records: DataFrame, mapping: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Each record's shard and its place in the shard, gapless from 0.

    Places are counted within slots and shifted by the rows of the shard's earlier slots, so no task holds a shard.
    The map has at most SLOTS rows, so it is broadcast.
    """
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = mapping.select("virtual_slot", "shard", "map_version", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("virtual_slot").orderBy(id_col, "text_crc32", "size")
    return records.withColumn("n", F.row_number().over(inside)).join(F.broadcast(starts), "virtual_slot").withColumn("slot", (F.col("start") + F.col("n") - 1).cast("bigint"))


def op3(spark, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of nearly equal bytes, placed by the stored map."""
    path = f"{shared_dir(spark)}/slots"
    records = sized(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    store_map(slot_map(slot_stats(records)), path)
    placed = place(records, load_map(spark, path))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version")
