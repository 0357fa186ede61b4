"""Contiguous shards of nearly equal byte size (op1), in DataFrame operations only.

Rows are range-partitioned by id and stored once as (id, size, checksum). Each
partition's byte and row totals give its global offsets; a running sum inside
the partition turns them into every row's global byte prefix, and the prefix
is cut at equal targets. Only partition totals (one row per partition) and
shard starts (one row per shard) are broadcast.

Defined cases: NULL or empty text counts no bytes (checksum of empty text);
NULL ids sort first; rows with equal ids keep a stable order by checksum and
then input position, so a repeated id spreads over partitions; an empty table
gives an empty result; a text larger than a shard's target is one row and
goes whole to the shard that holds its middle. Other columns of the input are
not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_width, stored

#: Bytes that a row counts besides its text.
ROW_OVERHEAD = 16


def shard_by_bytes(docs: DataFrame, n_shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, shard, slot): shards are runs of the id order with nearly equal bytes.

    A row belongs to the shard in which the middle of its byte range falls, so
    each cut is off its target by half a row at most. Products stay within a
    long up to 10**17 bytes at 40 shards.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    order = ["id", "crc", "tie"]
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        (F.octet_length(text).cast("long") + ROW_OVERHEAD).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("crc"),
        F.monotonically_increasing_id().alias("tie"),
    )
    rows = stored(
        rows.repartitionByRange(shuffle_width(spark), *order).withColumn("part", F.spark_partition_id()), "shard-rows"
    )

    totals = rows.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("byte0"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("row0"),
        F.sum("bytes").over(Window.partitionBy()).alias("total"),
    )

    within = Window.partitionBy("part").orderBy(*order)
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        rows.select("*", F.sum("size").over(upto).alias("upto"), F.row_number().over(within).alias("nth"))
        .join(F.broadcast(offsets), "part")
        .select(
            "id", "size", "crc",
            (F.col("row0") + F.col("nth") - 1).alias("row"),
            F.expr(f"cast((2 * (byte0 + upto) - size) * {n_shards} div (2 * total) as int)").alias("shard"),
        )
    )
    placed = stored(placed, "shard-placed")
    starts = placed.groupBy("shard").agg(F.min("row").alias("first"))
    return placed.join(F.broadcast(starts), "shard").select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard",
        (F.col("row") - F.col("first")).alias("slot"),
    )
