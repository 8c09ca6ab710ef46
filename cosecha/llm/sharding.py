"""Sharding (operator 9): fixed virtual slots.

Records are hashed into a fixed number of virtual slots by id and text; bytes
are summed per slot; a versioned table maps slots to shards. The heaviest slot
goes to the lightest shard first, so sizes come out near equal; a new version
of the map (``rebalance``) moves only as many slots as the new shards need, and
no record is hashed again.

The table of slots has ``slots`` rows whatever the data, so the map is a
bounded broadcast. DataFrame and SQL functions only.

Defined cases: a null text has no bytes (size 1, crc32 of nothing); a null
``doc_id`` is hashed like any value; repeated rows and equal texts are placed
one by one; an empty table gives no rows and a map of empty slots; columns
other than id and text are ignored. Equal sums are ordered by slot number.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cosecha.llm.common import prepare, store

SHARDS = 16
SLOTS = 4096
#: rows numbered in one sort: slots are cut into chunks of about this many
CHUNK_ROWS = 100_000

SLOT_MAP = "version int, virtual_slot int, bytes long, shard int"


def sized(docs: DataFrame, slots: int = SLOTS, chunks: int = 1, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot, chunk."""
    data = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    hashed = F.xxhash64(F.col(id_col), F.col(text_col))
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(data) + 1).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"), F.pmod(hashed, F.lit(slots)).cast("int").alias("virtual_slot"),
        # equal rows share a hash: the place in the input keeps them apart
        F.pmod(F.xxhash64(hashed, F.monotonically_increasing_id()), F.lit(chunks)).cast("int").alias("chunk"))


def _place(slots: DataFrame, shards: int) -> DataFrame:
    """virtual_slot, bytes, shard: the heaviest slot to the lightest shard."""
    state = F.struct(F.array_repeat(F.lit(0).cast("long"), shards).alias("load"),
                     F.array().cast("array<int>").alias("shard"))
    step = lambda acc, s: F.struct(
        F.transform(acc["load"], lambda x, i: F.when(
            i == F.array_position(acc["load"], F.array_min(acc["load"])) - 1, x + s["bytes"]).otherwise(x)).alias("load"),
        F.concat(acc["shard"], F.array((F.array_position(acc["load"], F.array_min(acc["load"])) - 1).cast("int")))
        .alias("shard"))
    row = slots.agg(F.array_sort(F.collect_list(F.struct((-F.col("bytes")).alias("o"), "virtual_slot", "bytes")))
                    .alias("s"))
    row = row.select("s", F.aggregate("s", state, step, lambda acc: acc["shard"]).alias("shard"))
    return row.select(F.explode(F.arrays_zip("s", "shard")).alias("e")) \
        .select("e.s.virtual_slot", "e.s.bytes", "e.shard")


def slot_map(sizes: DataFrame, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """Version 1 of the slot-to-shard map, stored."""
    spark = sizes.sparkSession
    every = spark.range(slots).select(F.col("id").cast("int").alias("virtual_slot"))
    summed = every.join(sizes.groupBy("virtual_slot").agg(F.sum("size").alias("bytes")), "virtual_slot", "left") \
        .select("virtual_slot", F.coalesce("bytes", F.lit(0).cast("long")).alias("bytes"))
    return store(_place(summed, shards).select(F.lit(1).cast("int").alias("version"), "virtual_slot", "bytes", "shard"),
                 "slot-map")


def latest(versions: DataFrame) -> DataFrame:
    """The newest version of a map."""
    newest = versions.agg(F.max("version").alias("version"))
    return versions.join(F.broadcast(newest), "version", "left_semi")


def rebalance(versions: DataFrame, shards: int) -> DataFrame:
    """``versions`` with one version more, for ``shards`` shards: of every shard
    that holds more than the new mean, the slots beyond it move to the lightest
    shards; all other slots stay. With fewer shards, the slots of those that
    are gone move."""
    now = latest(versions)
    mean = now.agg((F.sum("bytes") / F.lit(shards)).alias("mean"))
    upto = Window.partitionBy("shard").orderBy(F.desc("bytes"), "virtual_slot") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = now.withColumn("upto", F.sum("bytes").over(upto)).crossJoin(F.broadcast(mean)) \
        .withColumn("stays", (F.col("shard") < shards) & (F.col("upto") <= F.col("mean")))
    kept = marked.where("stays").select("virtual_slot", "bytes", "shard")
    loads = kept.groupBy("shard").agg(F.sum("bytes").alias("bytes"))
    first = now.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard")).join(loads, "shard", "left") \
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("shard", F.coalesce("bytes", F.lit(0).cast("long"))
                                                              .alias("bytes")))), lambda x: x["bytes"]).alias("load"))
    rest = marked.where(~F.col("stays")).agg(F.array_sort(F.collect_list(
        F.struct((-F.col("bytes")).alias("o"), "virtual_slot", "bytes"))).alias("s"))
    step = lambda acc, s: F.struct(
        F.transform(acc["load"], lambda x, i: F.when(
            i == F.array_position(acc["load"], F.array_min(acc["load"])) - 1, x + s["bytes"]).otherwise(x)).alias("load"),
        F.concat(acc["shard"], F.array((F.array_position(acc["load"], F.array_min(acc["load"])) - 1).cast("int")))
        .alias("shard"))
    moved = rest.crossJoin(F.broadcast(first)).select("s", F.aggregate(
        "s", F.struct("load", F.array().cast("array<int>").alias("shard")), step, lambda acc: acc["shard"]).alias("shard"))
    moved = moved.select(F.explode(F.arrays_zip("s", "shard")).alias("e")) \
        .select("e.s.virtual_slot", "e.s.bytes", "e.shard")
    version = now.agg((F.max("version") + 1).cast("int").alias("version"))
    new = kept.union(moved).crossJoin(F.broadcast(version)).select("version", "virtual_slot", "bytes", "shard")
    return store(versions.union(new), "slot-map")


def assign(sizes: DataFrame, slot_to_shard: DataFrame) -> DataFrame:
    """sizes with ``shard`` and ``slot``, the row's gapless place in its shard:
    rows are numbered inside (virtual slot, chunk), and those counts are added
    up, so no task sorts a whole shard."""
    placed = sizes.join(F.broadcast(slot_to_shard.select("virtual_slot", "shard")), "virtual_slot")
    counts = placed.groupBy("shard", "virtual_slot", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = counts.groupBy("shard", "virtual_slot").agg(F.sum("n").alias("n")).select(
        F.col("virtual_slot").alias("v"), F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("at"))
    inside = Window.partitionBy("virtual_slot").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("in_slot", F.coalesce(F.sum("n").over(inside), F.lit(0).cast("long"))) \
        .join(slots, F.col("virtual_slot") == F.col("v")) \
        .select("virtual_slot", "chunk", (F.col("at") + F.col("in_slot")).alias("at"))
    row = Window.partitionBy("virtual_slot", "chunk").orderBy("doc_id", "text_crc32", "size")
    return placed.withColumn("nth", F.row_number().over(row) - 1).join(starts, ["virtual_slot", "chunk"]) \
        .select("doc_id", "size", "text_crc32", "shard", (F.col("at") + F.col("nth")).cast("long").alias("slot"),
                "virtual_slot")


def shard_documents(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Place every document: doc_id, size, text_crc32, law, shard, slot,
    grown_shard, virtual_slot."""
    prepare(docs.sparkSession)
    chunks = max(1, math.ceil(docs.count() / (slots * CHUNK_ROWS)))
    sizes = store(sized(docs, slots, chunks, id_col, text_col), "sizes")
    return assign(sizes, slot_map(sizes, shards, slots)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")
