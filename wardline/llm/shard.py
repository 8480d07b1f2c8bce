"""Sharding (operator 1): fixed virtual slots and a versioned slot-to-shard map.

Records hash into ``SLOTS`` virtual slots, for good.  Bytes are summed per
slot, and a map of slots to shards is stored as numbered versions.  A
rebalance edits the map: slots stay where they are while their shard is within
its even share, and only the rest move, the heaviest first, each to the shard
that is lightest then.  Records never hash anew.

DataFrame functions only; the one sequential step runs over the ``SLOTS`` rows
of the map, whatever the number of records.

Edge cases: a null text has no bytes; a null id hashes like any value; rows that
repeat hash with their place in the table too, so that any number of them spreads
over all slots and the law holds; an empty table gives no rows and a map of empty
slots; extra columns are ignored.  Equal texts of different ids are records of
their own and may lie in different shards (their ``text_crc32`` tells them).  One
record larger than a shard's even share cannot be evened out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.llm.common import fresh, stage
from wardline.operators.joins import keyed_join

SLOTS = 4096
SHARDS = 40
ROW_BYTES = 16


def records(docs: DataFrame, slots: int = SLOTS, doc_id: str = "doc_id",
            text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, virtual_slot`` of every record.

    The records are stored once.  Those of a hash that occurs again take their
    place in the store into a second hash.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = stage(docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        (F.octet_length(body).cast("long") + F.lit(ROW_BYTES)).alias("size"),
        F.crc32(body).alias("text_crc32"),
    ).withColumn("_hash", F.xxhash64("doc_id", "text_crc32")).withColumn("_place", F.monotonically_increasing_id()), "records")
    again = stage(rows.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"), "repeated")
    marked = keyed_join(rows, again, ["_hash", "_n"], "_hash", "left")
    own = F.when(F.col("_n").isNull(), F.col("_hash")).otherwise(F.xxhash64("_hash", "_place"))
    return marked.select("doc_id", "size", "text_crc32", F.pmod(own, F.lit(slots)).cast("int").alias("virtual_slot"))


def loads(rows: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Bytes and rows of every slot, empty ones too (``slots`` rows)."""
    used = rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"),
                                            F.count(F.lit(1)).alias("n"))
    every = rows.sparkSession.range(slots).select(F.col("id").cast("int").alias("virtual_slot"))
    return every.join(F.broadcast(used), "virtual_slot", "left").select(
        "virtual_slot", F.coalesce("bytes", F.lit(0)).alias("bytes"),
        F.coalesce("n", F.lit(0)).alias("n"))


def rebalance(slot_loads: DataFrame, shards: int = SHARDS,
              old: DataFrame | None = None) -> DataFrame:
    """The next map: ``virtual_slot, shard, bytes, n``.

    ``old`` is the map in force.  Per shard its slots stay, largest first,
    while their sum is at most the even share; the others are placed, largest
    first, on the lightest shard.  Without ``old`` every slot is placed.
    """
    rows = slot_loads.withColumn("old", F.lit(None).cast("int"))
    if old is not None:
        rows = slot_loads.join(F.broadcast(old.select("virtual_slot", F.col("shard").alias("old"))),
                               "virtual_slot", "left")
        rows = rows.withColumn("old", F.when(F.col("old") < shards, F.col("old")))
    heavy = [F.col("bytes").desc(), F.col("virtual_slot")]
    share = F.sum("bytes").over(Window.partitionBy()) / F.lit(shards)
    run = F.sum("bytes").over(Window.partitionBy("old").orderBy(*heavy))
    rows = rows.withColumn("stays", F.col("old").isNotNull() & (run <= share))
    packed = rows.agg(
        F.array_sort(F.collect_list(F.when(~F.col("stays"), F.struct(
            (-F.col("bytes")).alias("neg"), "virtual_slot", "n")))).alias("moves"),
        F.collect_list(F.when(F.col("stays"), F.struct(
            "virtual_slot", F.col("old").alias("shard"), "bytes", "n"))).alias("fixed"))
    start = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.aggregate(
        F.filter("fixed", lambda x: x["shard"] == s), F.lit(0).cast("long"),
        lambda a, x: a + x["bytes"]))

    def place(acc, x):
        at = F.array_position(acc["load"], F.array_min(acc["load"])).cast("int") - 1
        return F.struct(
            F.transform(acc["load"], lambda v, i: F.when(i == at, v - x["neg"]).otherwise(v)).alias("load"),
            F.concat(acc["out"], F.array(F.struct(
                x["virtual_slot"].alias("virtual_slot"), at.alias("shard"),
                (-x["neg"]).alias("bytes"), x["n"].alias("n")))).alias("out"))

    kind = "array<struct<virtual_slot:int,shard:int,bytes:bigint,n:bigint>>"
    done = F.aggregate("moves", F.struct(start.alias("load"), F.array().cast(kind).alias("out")),
                       place, lambda acc: acc["out"])
    return packed.select(F.inline(F.concat(F.col("fixed").cast(kind), done)))


class SlotMap:
    """Numbered versions of a slot map below one folder; a version is never changed."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or fresh(spark, "slot-map")

    def write(self, mapped: DataFrame, version: int) -> DataFrame:
        mapped.coalesce(1).write.mode("errorifexists").parquet(f"{self.path}/version={version}")
        return self.read(version)

    def read(self, version: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/version={version}")


def assign(rows: DataFrame, mapped: DataFrame) -> DataFrame:
    """Every record with its ``shard`` and ``slot``, its place there (gapless from 0).

    A record's place is its slot's first place in the shard plus its rank in the
    slot; ranking goes by slot, so no task gets a whole shard.
    """
    first = mapped.withColumn("first", F.sum("n").over(
        Window.partitionBy("shard").orderBy("virtual_slot")) - F.col("n"))
    rank = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32"))
    return (rows.withColumn("rank", rank.cast("long") - 1)
            .join(F.broadcast(first.select("virtual_slot", "shard", "first")), "virtual_slot")
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("first") + F.col("rank")).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), "virtual_slot"))


def shard(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS,
          store: SlotMap | None = None, version: int = 1) -> DataFrame:
    """Shard ``docs``; the map in force goes to ``store`` as ``version``.

    Version 1 is made from the loads alone; a later one edits its predecessor.
    """
    store = store or SlotMap(docs.sparkSession)
    rows = stage(records(docs, slots), "placed")
    old = store.read(version - 1) if version > 1 else None
    mapped = store.write(rebalance(loads(rows, slots), shards, old), version)
    return assign(rows, mapped)
