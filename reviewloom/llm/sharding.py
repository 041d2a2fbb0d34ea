"""Sharding by fixed virtual slots and a stored, versioned map from slots to shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from reviewloom.session import shared_dir

SLOTS = 4096


def record_bytes(text: str = "text") -> Column:
    """UTF-8 bytes of the text (null: none) plus 8."""
    return (F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)) + 8).cast("long")


def slot_of(key: str = "doc_id", slots: int = SLOTS) -> Column:
    """The record's virtual slot: it depends on the key alone and never changes."""
    return F.pmod(F.xxhash64(F.lit("slot"), F.col(key)), F.lit(slots).cast("long")).cast("int")


def slot_bytes(sizes: DataFrame, slots: int = SLOTS) -> DataFrame:
    """slot, rows, bytes of every slot, also of empty ones. Summed up before the shuffle; ``slots`` rows at most."""
    found = sizes.groupBy("slot").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"))
    every = sizes.sparkSession.range(slots).select(F.col("id").cast("int").alias("slot"))
    return every.join(found, "slot", "left").select(
        "slot", F.coalesce("rows", F.lit(0)).cast("long").alias("rows"),
        F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes"))


def first_map(slots: DataFrame, shards: int) -> DataFrame:
    """version 1: slot, shard. The largest slot first, each to the shard that has the fewest bytes so far.

    One row holds the slots in that order (there are ``SLOTS`` of them, whatever the number of records) and
    a fold over it keeps the shards' loads.
    """
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("bytes")).alias("less"), "slot")))
    start = F.struct(F.array_repeat(F.lit(0).cast("long"), shards).alias("loads"), F.array().cast("array<int>").alias("to"))

    def step(state: Column, item: Column) -> Column:
        place = F.array_position(state["loads"], F.array_min(state["loads"])).cast("int")
        return F.struct(
            F.transform(state["loads"], lambda x, i: F.when(i == place - 1, x - item["less"]).otherwise(x)).alias("loads"),
            F.concat(state["to"], F.array(place - 1)).alias("to"))

    folded = slots.agg(ordered.alias("items")).select("items", F.reduce("items", start, step)["to"].alias("to"))
    return folded.select(F.explode(F.arrays_zip("items.slot", "to")).alias("x")).select(
        F.lit(1).alias("version"), F.col("x")["slot"].alias("slot"), F.col("x")["to"].alias("shard"))


def grown_map(current: DataFrame, slots: DataFrame, shards: int) -> DataFrame:
    """The next version, with one shard more: every old shard gives slots to it, and nothing else moves.

    A shard gives up its smallest slots for as long as they stay within the part of its bytes that is
    above the new even share.
    """
    table = current.join(slots, "slot")
    share = F.sum("bytes").over(Window.partitionBy(F.lit(0))) / F.lit(shards + 1)
    table = table.withColumn("share", share).withColumn("own", F.sum("bytes").over(Window.partitionBy("shard")))
    so_far = Window.partitionBy("shard").orderBy("bytes", "slot").rowsBetween(Window.unboundedPreceding, 0)
    gives = (F.col("bytes") > 0) & (F.sum("bytes").over(so_far) <= F.col("own") - F.col("share"))
    return table.select((F.col("version") + 1).alias("version"), "slot",
                        F.when(gives, F.lit(shards)).otherwise(F.col("shard")).alias("shard"))


class SlotMap:
    """The stored map: one Parquet folder per version, never changed once written."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or shared_dir(spark, "slot-map")

    def store(self, table: DataFrame, version: int) -> DataFrame:
        table.select("version", "slot", "shard").coalesce(1).write.parquet(f"{self.path}/version={version}")
        return self.read(version)

    def read(self, version: int) -> DataFrame:
        schema = "version int, slot int, shard int"
        return self.spark.read.schema(schema).parquet(f"{self.path}/version={version}")


def assign(records: DataFrame, shards: int, slots: int = SLOTS, path: str | None = None) -> DataFrame:
    """``records`` (a stored table: doc_id, size, ...) with virtual_slot, shard, slot and grown_to.

    ``shard`` follows version 1 of the map, ``grown_to`` version 2, which has one shard more; ``slot`` is
    the record's place in its shard, from 0 without gaps: the rows of the shard's earlier virtual slots,
    and the place by doc_id within its own. The map has ``slots`` rows and is sent to every task; records
    move once, by slot. Rows that repeat an id share its slot; a null id has the slot of the null; an empty
    table gives an empty result.
    """
    table = records.withColumn("virtual_slot", slot_of("doc_id", slots))
    figures = slot_bytes(table.select(F.col("virtual_slot").alias("slot"), "size"), slots)
    store = SlotMap(records.sparkSession, path)
    first = store.store(first_map(figures, shards), 1)
    second = store.store(grown_map(first, figures, shards), 2)
    before = Window.partitionBy("shard").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    begins = first.join(figures, "slot").select(
        F.col("slot").alias("virtual_slot"), "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("_begin"))
    begins = begins.join(second.select(F.col("slot").alias("virtual_slot"), F.col("shard").alias("grown_to")), "virtual_slot")
    inside = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "size"))
    return table.withColumn("_inside", inside).join(F.broadcast(begins), "virtual_slot").withColumn(
        "slot", (F.col("_begin") + F.col("_inside") - 1).cast("long")).drop("_begin", "_inside")
