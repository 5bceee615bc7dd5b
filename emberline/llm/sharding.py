"""Sharding by fixed virtual slots.

Records hash into thousands of slots that never change. A small versioned map says which shard
holds which slot. Rebalancing sums bytes per slot and edits the map: only slots of overfull shards
move, so data moves slot by slot and a reader needs the map alone to find a record.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .session import save, utf8_bytes

#: Fixed for the life of a data set. The map has so many rows, whatever the number of records.
SLOTS = 8192


@dataclass(frozen=True)
class SlotMap:
    """``shard_of[slot]``; ``version`` rises by one with every edit."""

    version: int
    shards: int
    shard_of: tuple[int, ...]

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(self.version, self.shards, slot, shard) for slot, shard in enumerate(self.shard_of)]
        return spark.createDataFrame(rows, "version int, shards int, virtual_slot int, shard int")


def first_map(shards: int, slots: int = SLOTS) -> SlotMap:
    """Version 1: slots dealt round-robin, before any size is known."""
    return SlotMap(1, shards, tuple(s % shards for s in range(slots)))


def rebalance(old: SlotMap, weight: dict[int, int], shards: int | None = None) -> SlotMap:
    """The next version of the map: every shard keeps its largest slots up to the mean load; what is
    over goes, largest first, to the shard that has least. Slots without records stay where they are.
    """
    shards = shards or old.shards
    target = sum(weight.values()) / shards
    order = sorted(range(len(old.shard_of)), key=lambda s: (-weight.get(s, 0), s))
    load, shard_of, over = [0] * shards, list(old.shard_of), []
    for s in order:
        shard, w = shard_of[s], weight.get(s, 0)
        if shard < shards and (load[shard] + w <= target or not w):
            load[shard] += w
        else:
            over.append(s)
    heap = [(load[k], k) for k in range(shards)]
    heapq.heapify(heap)
    for s in over:
        least, k = heapq.heappop(heap)
        shard_of[s] = k
        heapq.heappush(heap, (least + weight.get(s, 0), k))
    return SlotMap(old.version + 1, shards, tuple(shard_of))


def stored_map(spark: SparkSession, path: str) -> SlotMap | None:
    """The last version of the map in the table ``path``; None if there is none yet."""
    try:
        versions = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    last = versions.agg(F.max("version")).first()[0]
    rows = versions.where(F.col("version") == last).orderBy("virtual_slot").collect()  # a row for each slot
    return SlotMap(last, rows[0]["shards"], tuple(r["shard"] for r in rows))


def virtual_slot(*columns, slots: int = SLOTS):
    return F.pmod(F.xxhash64(*columns), F.lit(slots)).cast("int")


#: Copies of one record are numbered in so many buckets.
COPY_BUCKETS = 64


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 of each record, with a number that tells rows apart and a key that copies share; the text itself isn't carried on."""
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    rows = docs.select("doc_id", (utf8_bytes() + 16).alias("size"), crc.alias("text_crc32"), F.monotonically_increasing_id().alias("number"))
    return rows.withColumn("copy_key", F.xxhash64("doc_id", "text_crc32", "size"))


def slotted(records: DataFrame, slots: int) -> DataFrame:
    """``records`` (of ``sized``) with their virtual slot, by the hash of id and CRC.

    Copies of one record (the same id, or none, and the same text) that would fill more than their slot's share are numbered from 0, and the
    number is hashed too. There are fewer such records than slots, so all tasks know them; which copy gets which number doesn't matter."""
    total = records.count()
    hot = F.broadcast(records.groupBy("copy_key").agg(F.count("*").alias("n")).where((F.col("n") > 1) & (F.col("n") * slots > total)).select("copy_key"))
    single = records.join(hot, "copy_key", "left_anti").withColumn("virtual_slot", virtual_slot("doc_id", "text_crc32", slots=slots))
    copies = records.join(hot, "copy_key", "left_semi").withColumn("bucket", F.pmod(F.xxhash64("number"), F.lit(COPY_BUCKETS)).cast("int"))
    counts = copies.groupBy("copy_key", "bucket").agg(F.count("*").alias("n"))
    before = counts.select("copy_key", "bucket", (F.sum("n").over(Window.partitionBy("copy_key").orderBy("bucket")) - F.col("n")).alias("before"))
    nth = F.row_number().over(Window.partitionBy("copy_key", "bucket").orderBy("number"))
    copies = copies.withColumn("nth", nth).join(F.broadcast(before), ["copy_key", "bucket"]).withColumn("copy", F.col("before") + F.col("nth") - 1)
    copies = copies.withColumn("virtual_slot", virtual_slot("doc_id", "text_crc32", "copy", slots=slots))
    columns = ["doc_id", "size", "text_crc32", "number", "virtual_slot"]
    return single.select(*columns).unionByName(copies.select(*columns))


def shard_documents(docs: DataFrame, shards: int, slots: int = SLOTS, map_path: str | None = None) -> tuple[DataFrame, list[SlotMap]]:
    """Every record with its virtual slot, shard and place in the shard (0, 1, ... without gaps);
    also the versions of the map from the one that was found on.

    With ``map_path``, the last version in that table is edited (its number of slots holds), and a new version is added to
    it if any slot moves. Without, the first map is edited, and the versions are written to the shared folder.

    Null ids and null texts are records like others (a null text has size 16). Rows that repeat in
    full are kept, and get places of their own. Of further columns nothing is used. An empty table
    gives no rows and the first map.
    """
    spark = docs.sparkSession
    found = stored_map(spark, map_path) if map_path else None
    maps = [found or first_map(shards, slots)]
    slots = len(maps[0].shard_of)
    records = save(slotted(save(sized(docs), "sized"), slots), "slotted")
    per_slot = {
        r.virtual_slot: (r.bytes, r.rows)
        for r in records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()
    }  # `slots` rows at most
    if per_slot or shards != maps[0].shards:
        edited = rebalance(maps[0], {s: b for s, (b, _) in per_slot.items()}, shards)
        if (edited.shards, edited.shard_of) != (maps[0].shards, maps[0].shard_of):
            maps.append(edited)
    for m in maps[1:] if found else maps:
        if map_path:
            m.frame(spark).coalesce(1).write.mode("append").parquet(map_path)
        else:
            save(m.frame(spark).coalesce(1), "slot_map")

    current, filled, rows = maps[-1], [0] * shards, []
    for s, shard in enumerate(current.shard_of):
        rows.append((s, shard, filled[shard], current.version))
        filled[shard] += per_slot.get(s, (0, 0))[1]
    placed = spark.createDataFrame(rows, "virtual_slot int, shard int, before long, map_version int")
    in_slot = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size", "number")
    return (
        records.withColumn("nth", F.row_number().over(in_slot) - 1)
        .join(F.broadcast(placed), "virtual_slot")
        .withColumn("slot", (F.col("before") + F.col("nth")).cast("long"))
        .drop("before", "nth", "number"),
        maps,
    )


def op1_sharding(spark: SparkSession, docs: DataFrame, shards: int = 40) -> DataFrame:
    """Law ``bytes``: the shards' sizes are near equal."""
    out, _ = shard_documents(docs, shards)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version",
    )
