"""Sharding (op1): fixed virtual slots and a versioned slot-to-shard map.

Records are hashed into thousands of slots.  Only bytes per slot are aggregated, and only slots
are moved: the map is a log of ``(version, slot, shard)``, version 0 dealing slots out in turn
and every later version holding the slots that a rebalancing moved.  A slot stays where it is
while its shard's larger slots leave room below the mean; the rest go, largest first, to the
shard that is then lightest.  That last step is one fold over at most ``slots`` rows, which is a
parameter and doesn't grow with the data.

The law is ``bytes``: shards are near equal in bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollcall.llm.store import table, written
from rollcall.session import scratch_path

SLOTS = 8192
COPIES = 10_000  # of one row that are numbered at once


def records(docs: DataFrame, doc_id: str, text: str, slots: int) -> DataFrame:
    """``doc_id, size, text_crc32, copy, virtual_slot`` per row.

    Repeated rows are counted in a map-side combine and numbered again afterwards, so that a row
    that is repeated very often spreads over the slots like any others.
    """
    sized = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.col(text).cast("binary")).alias("text_crc32"),
    )
    counted = sized.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("copies"))
    # in blocks, so that no array is as long as the copies of one row
    blocks = F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {COPIES}"))
    each = counted.select("doc_id", "size", "text_crc32", "copies", F.explode(blocks).alias("block"))
    first = F.col("block") * COPIES + 1
    each = each.select("doc_id", "size", "text_crc32", F.explode(F.sequence(first, F.least("copies", first + COPIES - 1))).alias("copy"))
    return each.withColumn("virtual_slot", F.pmod(F.xxhash64("doc_id", "text_crc32", "copy"), F.lit(slots)).cast("int"))


def slot_sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))


def first_map(spark: SparkSession, slots: int, shards: int) -> DataFrame:
    """Version 0: all slots in turn."""
    each = spark.range(slots).select(F.lit(0).alias("version"), F.col("id").cast("int").alias("slot"))
    return each.withColumn("shard", F.col("slot") % shards)


def current(log: DataFrame) -> DataFrame:
    """``slot, shard, since`` as the latest version has it."""
    return log.groupBy("slot").agg(F.max_by("shard", "version").alias("shard"), F.max("version").alias("since"))


def rebalance(log: DataFrame, sizes: DataFrame, shards: int, version: int) -> DataFrame:
    """The slots that move in ``version``, for ``shards`` shards; those of removed shards all move."""
    known = current(log).join(sizes, F.col("slot") == F.col("virtual_slot"), "left")
    known = known.select("slot", "shard", F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes"))
    largest = Window.partitionBy("shard").orderBy(F.desc("bytes"), "slot")
    known = known.withColumns({"upto": F.sum("bytes").over(largest), "mean": F.sum("bytes").over(Window.partitionBy(F.lit(0))) / shards})
    known = known.withColumn("stays", (F.col("upto") <= F.col("mean")) & (F.col("shard") < shards))
    # one row: an entry per slot, of which there is a fixed number
    whole = known.agg(F.collect_list(F.struct("stays", "shard", "bytes", "slot")).alias("slots"))
    load = "aggregate(filter(slots, x -> x.stays and x.shard = s), 0L, (a, x) -> a + x.bytes)"
    whole = whole.select(
        F.expr(f"transform(sequence(0, {shards - 1}), s -> {load})").alias("loads"),
        F.expr("sort_array(transform(filter(slots, x -> not x.stays), x -> named_struct('less', -x.bytes, 'slot', x.slot, 'shard', x.shard)))").alias("moving"),
    )
    dealt = """aggregate(moving, named_struct('loads', loads, 'to', cast(array() as array<int>)),
        (acc, x) -> named_struct(
            'loads', transform(acc.loads, (load, i) -> if(i + 1 = array_position(acc.loads, array_min(acc.loads)), load - x.less, load)),
            'to', concat(acc.to, array(cast(array_position(acc.loads, array_min(acc.loads)) - 1 as int)))),
        acc -> acc.to)"""
    each = whole.select("moving", F.expr(dealt).alias("to")).select(F.posexplode("moving").alias("i", "m"), "to")
    moved = each.select(F.lit(version).alias("version"), "m.slot", F.col("m.shard").alias("was"), F.get("to", F.col("i")).alias("shard"))
    return moved.where("was <> shard").drop("was")


def place(rows: DataFrame, sizes: DataFrame, log: DataFrame) -> DataFrame:
    """``rows`` with ``shard``, ``map_version`` and ``slot``: the place in the shard, gapless from 0.

    Places are counted per virtual slot and shifted by the rows of the shard's earlier slots, so no
    task sees a whole shard.  The map has one row per slot, a fixed number, and is broadcast.
    """
    newest = F.max("since").over(Window.partitionBy(F.lit(0)))
    slots = current(log).withColumn("map_version", newest).join(sizes, F.col("slot") == F.col("virtual_slot")).drop("slot")
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0))).select("virtual_slot", "shard", "map_version", "before")
    within = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "copy")
    placed = rows.join(F.broadcast(slots), "virtual_slot").withColumn("slot", F.col("before") + F.row_number().over(within) - 1)
    return placed.drop("before")


def shard_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = 16, slots: int = SLOTS) -> DataFrame:
    """Every row's shard, near equal in bytes (UTF-8 bytes of the text, none for a null, plus 1).

    Null ids and texts are values like others; repeated rows are each placed.  A single row of
    more than a shard's share can't be divided.  No rows give no rows.
    """
    spark = docs.sparkSession
    rows = written(records(docs, doc_id, text, slots), "records")
    sizes = written(slot_sizes(rows), "slots")
    at = scratch_path(spark, "slotmap")
    first_map(spark, slots, shards).write.parquet(at)
    moved = written(rebalance(spark.read.parquet(at), sizes, shards, version=1), "moves")
    moved.write.mode("append").parquet(at)
    return place(rows, sizes, spark.read.parquet(at))


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_documents(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version",
    )
