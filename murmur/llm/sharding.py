"""Operator 5: sharding by fixed virtual slots.

A record is hashed by its key and text into one of ``SLOTS`` slots, for good. Bytes are
summed per slot, and a versioned table says which shard holds which slot. Version 0 deals
the slots out in turn; a rebalance edits it: from the largest slot to the smallest, a slot
stays where it is while its shard is within the mean, else it goes to the shard that has
least. The same edit takes up one more shard. Only column expressions are used; the slot
table has ``SLOTS`` rows whatever the data holds.

Law ``bytes``: the shards' bytes are near equal. Rows are numbered within a shard from
counts per task; a hot source or key changes nothing, as slots don't follow them.

Defined results: null text has no bytes and checksum 0; a null key is hashed like any
value; rows equal in key and text share a slot; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from murmur.session import materialize

SLOTS = 4096
SHARDS = 24
OVERHEAD = 8


def records(docs: DataFrame, key: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """(key, size, text_crc32, virtual_slot) of every row; the text stays behind."""
    return docs.select(
        key,
        (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit(""))).alias("text_crc32"),
        F.pmod(F.xxhash64(key, text), F.lit(slots)).cast("int").alias("virtual_slot"),
    )


def slot_bytes(rows: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(virtual_slot, bytes) of every slot, empty ones too."""
    spark = rows.sparkSession
    found = rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"))
    every = spark.range(slots).select(F.col("id").cast("int").alias("virtual_slot"))
    return every.join(found, "virtual_slot", "left").na.fill(0, ["bytes"])


def first_map(slots: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(virtual_slot, shard, bytes): slots dealt out in turn."""
    return slots.select("virtual_slot", (F.col("virtual_slot") % shards).alias("shard"), "bytes")


def rebalanced(held: DataFrame, shards: int) -> DataFrame:
    """``held``, (virtual_slot, shard, bytes), edited for ``shards`` shards of near equal
    bytes. One row holds all slots: their number is fixed."""
    one = held.agg(
        F.sort_array(F.collect_list(F.struct((-F.col("bytes")).alias("less"), "virtual_slot", "shard"))).alias("slots"),
        (F.sum("bytes") / shards).alias("mean"),
    )
    kept = "element_at(s.loads, x.shard + 1) - x.less <= mean"
    least = "array_position(s.loads, array_min(s.loads)) - 1"
    owner = f"CASE WHEN x.shard < {shards} AND {kept} THEN x.shard ELSE CAST({least} AS int) END"
    step = f"""
        transform(array({owner}), o -> named_struct(
            'loads', transform(s.loads, (l, i) -> IF(i = o, l - x.less, l)),
            'owners', concat(s.owners, array(o))))[0]"""
    start = f"named_struct('loads', array_repeat(CAST(0 AS bigint), {shards}), 'owners', CAST(array() AS array<int>))"
    edited = one.select("slots", F.expr(f"aggregate(slots, {start}, (s, x) -> {step}).owners").alias("owners"))
    return edited.select(F.expr("inline(arrays_zip(slots, owners))")).select(
        "slots.virtual_slot", F.col("owners").alias("shard"), (-F.col("slots.less")).alias("bytes")
    )


def versions(rows: DataFrame, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """(version, virtual_slot, shard, bytes): the first map and its rebalanced edit,
    written to the shared folder."""
    first = first_map(materialize(slot_bytes(rows, slots)), shards)
    return materialize(
        first.select(F.lit(0).alias("version"), "*").unionByName(rebalanced(first, shards).select(F.lit(1).alias("version"), "*"))
    )


def place(rows: DataFrame, held: DataFrame) -> DataFrame:
    """``rows`` with their shard in ``held`` and their place there, ``slot``, from 0."""
    owner = F.broadcast(held.select("virtual_slot", "shard"))  # a row for each slot
    number = F.monotonically_increasing_id()
    placed = materialize(
        rows.join(owner, "virtual_slot")
        .sortWithinPartitions("shard")
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_place", number.bitwiseAND(F.lit((1 << 33) - 1)))
    )
    counts = placed.groupBy("_part", "shard").agg(F.min("_place").alias("_first"), F.count("*").alias("_rows"))
    before = W.partitionBy("shard").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("_part", "shard", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_start"))
    return (
        placed.join(starts, ["_part", "shard"])
        .withColumn("slot", F.col("_start") + F.col("_place"))
        .drop("_part", "_place", "_start")
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard, virtual_slot, version) of
    every row under the rebalanced map."""
    rows = materialize(records(docs, key, text))
    held = versions(rows, shards).filter(F.col("version") == 1)
    return place(rows, held).select(
        key, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", F.lit(1).alias("version"),
    )
