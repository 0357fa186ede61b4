"""The static side of a stream's join, read by key bucket.

A micro-batch needs only the rows that share its keys. The static table is kept beside itself in a copy cut by a hash
of the key, ``_key_bucket=b/_batch=e``, filled by a stream of its own; a join then opens the folders of the buckets
that its rows fall into and no others. A replayed micro-batch overwrites the folders it wrote before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from fleetspark.session import names_in
from fleetspark.sources.tables import BATCH
from fleetspark.streaming.runner import BUCKET, key_bucket, run_update_batches

BUCKETS = 256


def fill(stream: DataFrame, key: str, path: str, checkpoint: str, buckets: int = BUCKETS, wait: bool = True) -> StreamingQuery:
    """Append the rows of ``stream`` to their buckets; rows with a NULL key are left out, as they match nothing."""

    def append(batch: DataFrame, epoch_id: int) -> None:
        rows = batch.where(F.col(key).isNotNull()).withColumns({BUCKET: key_bucket([key], buckets), BATCH: F.lit(epoch_id)})
        rows = rows.hint("rebalance", BUCKET)  # a bucket's rows meet before they are written: files follow the buckets, not tasks times buckets
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET, BATCH).parquet(path)

    return run_update_batches(stream, append, checkpoint, wait=wait)


def read_matching(spark: SparkSession, path: str, schema: StructType, rows: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """The rows of the copy whose bucket some row of ``rows`` falls into (by its ``key``, of the same type)."""
    wanted = rows.where(F.col(key).isNotNull()).select(key_bucket([key], buckets).alias("b")).distinct()
    there = set(names_in(spark, path))
    folders = [f"{BUCKET}={r.b}" for r in wanted.collect()]  # at most ``buckets``
    paths = [f"{path}/{f}" for f in folders if f in there]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*paths).select(*schema.names)


def joining(
    spark: SparkSession, path: str, schema: StructType, key: str, join: Callable[[DataFrame, DataFrame], DataFrame], buckets: int = BUCKETS
) -> Callable[[DataFrame], DataFrame]:
    """``join(rows, matching)`` as a function of a micro-batch's rows."""
    return lambda rows: join(rows, read_matching(rows.sparkSession, path, schema, rows, key, buckets))
