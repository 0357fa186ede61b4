"""Event-time deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_within_watermark(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key.

    Stream: ``dropDuplicatesWithinWatermark`` -- the key is remembered until
    the watermark passes its event time plus the delay, so state stays bounded;
    NULL keys compare equal; the survivor is whichever row came first; rows
    later than the watermark are dropped one micro-batch after the naive
    reading (the late filter uses the previous batch's watermark).

    Batch: a sort-based aggregate (the buffer is a struct) keeping the greatest row per key (deterministic;
    partial aggregation collapses a hot key before the shuffle).
    """
    keys = list(keys)
    if df.isStreaming:
        return df.dropDuplicatesWithinWatermark(keys)
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.dropDuplicates(keys)
    return (
        df.groupBy(*keys)
        .agg(F.max(F.struct(*[F.col(c) for c in others])).alias("_row"))
        .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others])
        .select(*df.columns)
    )


WATERMARK_META = "spark.watermarkDelayMs"


def ensure_watermark(df: DataFrame, column: str, delay: str) -> DataFrame:
    """``withWatermark`` unless ``column`` already carries one (a builder
    composed after silver in the same query inherits silver's watermark;
    Spark refuses to redefine it). Batch frames pass through unchanged."""
    if not df.isStreaming:
        return df
    if WATERMARK_META in df.schema[column].metadata:
        return df
    return df.withWatermark(column, delay)
