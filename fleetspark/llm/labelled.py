"""Bounded sample of labelled documents for training, and the fold that is held out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored


def fold(id_col: str) -> Column:
    """crc32 of the id as text, modulo 3; fold 1 is never trained on."""
    return F.pmod(F.crc32(F.encode(F.col(f"`{id_col}`").cast("string"), "UTF-8")), F.lit(3))


def held_out(id_col: str) -> Column:
    return F.coalesce(fold(id_col) == 1, F.lit(False))


def training_rows(
    docs: DataFrame, labels: DataFrame, label_col: str, rows: dict[int, int], max_bytes: int, id_col: str = "doc_id", text_col: str = "text"
) -> list[tuple[str, int]]:
    """At most ``rows[label]`` texts of each label and ``max_bytes`` of text in all, outside fold 1.

    The choice goes by a hash of the id, so it doesn't depend on the partitioning. Ids that have both labels
    and texts that alone pass a hundredth of max_bytes are left out of the training.
    """
    known = (
        labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label"))
        .where(F.col("id").isNotNull() & F.col("label").isin(list(rows))).where(fold("id") != 1)
        .groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other")
    )
    order = [F.xxhash64("id"), F.col("id")]
    chosen = None
    for label, most in rows.items():
        part = known.where(F.col("label") == label).select("id", "label").orderBy(*order).limit(most)
        chosen = part if chosen is None else chosen.union(part)
    chosen = stored(chosen, "training-ids")
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    # the ids are bounded by the parameter rows, so they may be broadcast
    found = stored(
        texts.join(F.broadcast(chosen), "id").where(F.octet_length("text") <= max_bytes // 100)
        .withColumn("bytes", F.octet_length("text")).dropDuplicates(["id"]), "training-texts",
    )
    sizes = sorted((r.h, r.id, r.bytes) for r in found.select(F.xxhash64("id").alias("h"), "id", "bytes").collect())
    total, last = 0, None
    for h, i, n in sizes:
        if total + n > max_bytes:
            break
        total, last = total + n, (h, i)
    if last is None:
        return []
    within = found.where((F.xxhash64("id") < last[0]) | ((F.xxhash64("id") == last[0]) & (F.col("id") <= last[1])))
    return [(r.text, r.label) for r in within.orderBy(*order).collect()]
