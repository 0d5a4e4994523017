"""Contiguous shards of nearly equal bytes, cut from global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import text_bytes, write_through

LAW = "bytes"
ORDER = ["doc_id", "spread", "text_crc32", "size"]


def shard_by_bytes(docs: DataFrame, shards: int = 24, overhead: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: ``shards`` contiguous runs of documents by doc_id.

    The rows without their texts are dealt by ranges of doc_id; each range gives its total, the totals give the bytes
    and rows before each range, and a running sum inside a range gives those before a row. A row goes to the shard in
    whose equal part of all bytes its middle byte lies, so a shard misses the target by less than its two cut rows.
    Only totals (a row a range) and the shards' first rows leave the ranges.

    Null texts have no bytes but ``overhead``. Null doc_ids come first; rows that agree in doc_id are ordered by a hash
    of their text, and equal rows are interchangeable. An empty table has no rows. Other columns of ``docs`` are
    ignored, whatever their names; ``grown_shard`` is null, since this law moves rows when a shard is added.
    """
    data = text_bytes()
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.length(data) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        # repeated ids (and null ones) spread over ranges by their text
        F.xxhash64(data).alias("spread"),
    )
    ranged = sized.repartitionByRange(*ORDER).withColumn("range", F.spark_partition_id())
    ranged = write_through(ranged, "sized")
    totals = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    # one row a range: bounded by the number of partitions, not by the data
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        "range",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(everything).alias("all_bytes"),
    )
    inside = Window.partitionBy("range").orderBy(*ORDER)
    placed = (
        ranged.select(
            "*",
            (F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).alias("start"),
            F.row_number().over(inside).alias("nth"),
        )
        .join(F.broadcast(offsets), "range")
        .select(
            "doc_id",
            "size",
            "text_crc32",
            # in halves of bytes, in whole numbers: the middle is start + size / 2
            F.expr(f"int(least({shards - 1}, ((bytes_before + start) * 2 + size) * {shards} div (all_bytes * 2)))").alias(
                "shard"
            ),
            (F.col("rows_before") + F.col("nth") - 1).alias("place"),
        )
    )
    firsts = placed.groupBy("shard").agg(F.min("place").alias("first"))  # a row a shard
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        (F.col("place") - F.col("first")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
