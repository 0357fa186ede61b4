"""Running dataset builders as streams.

* append   -- stateless or watermarked outputs: the parquet file sink, exactly
  once through its commit log.
* upsert   -- unbounded aggregates without a watermark (daily revenue, fuel):
  update mode hands over the changed groups only; they replace their earlier
  rows in the buckets of a committed store, so what a micro-batch writes
  follows its changed groups, not all groups ever seen.
* complete -- results whose unchanged groups change, too (the scorecard, whose
  assignments are joined in): every micro-batch's whole result replaces the
  last one.

Both commit (``keyed_store``): a reader sees whole results only, a replayed
epoch isn't applied twice, and what was replaced is deleted by the next commit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetspark.session import apply_batch_conf, path_exists, remove_path
from fleetspark.streaming.keyed_store import KeyedStore

BUCKET = "_key_bucket"
ID = "_id"


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.hash(*[F.col(k) for k in keys]), F.lit(buckets))


def identity(keys: Sequence[str]) -> Column:
    """One non-null struct of the keys: NULL keys are equal to each other."""
    return F.struct(*[F.col(k) for k in keys])


def write_once(df: DataFrame, folder: str) -> None:
    """Write a micro-batch's rows; a replay that finds them written leaves them, so that no reader sees them twice."""
    spark = df.sparkSession
    if not path_exists(spark, f"{folder}/_SUCCESS"):
        df.write.mode("overwrite").parquet(folder)


def kept_aside(df: DataFrame, folder: str) -> DataFrame:
    """The rows of a micro-batch, written once and read back: later steps neither run the query's plan again nor lose it."""
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _check(q: StreamingQuery) -> StreamingQuery:
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return q


def run_append(df: DataFrame, path: str, checkpoint: str, query_name: str | None = None, wait: bool = True) -> StreamingQuery:
    w = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if query_name:
        w = w.queryName(query_name)
    q = w.start()
    return _check(q) if wait else q


def complete_store(spark: SparkSession, path: str) -> KeyedStore:
    return KeyedStore(spark, path, {"result": []})


def upsert_store(spark: SparkSession, path: str) -> KeyedStore:
    return KeyedStore(spark, path, {"groups": [BUCKET]})


def run_complete(df: DataFrame, path: str, checkpoint: str, query_name: str | None = None, wait: bool = True) -> StreamingQuery:
    def publish(batch: DataFrame, epoch_id: int) -> None:
        store = complete_store(batch.sparkSession, path)
        if not store.committed(epoch_id):
            store.commit(epoch_id, {"result": store.write("result", epoch_id, batch)})

    return run_update_batches(df, publish, checkpoint, query_name, wait, "complete")


def read_complete(spark: SparkSession, path: str) -> DataFrame:
    """The last committed result of a complete-mode output."""
    return complete_store(spark, path).read("result")


def run_upsert(
    df: DataFrame, keys: Sequence[str], path: str, checkpoint: str, buckets: int = 64, query_name: str | None = None, wait: bool = True
) -> StreamingQuery:
    """An aggregate by ``keys`` (NULL keys are groups, too): each micro-batch's changed groups replace their earlier rows."""

    def publish(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        store = upsert_store(spark, path)
        if store.committed(epoch_id):
            return
        aside = f"{path}/incoming/{epoch_id}"
        changed = kept_aside(batch.withColumn(BUCKET, key_bucket(keys, buckets).cast("string")), aside)
        cells = [(r[0],) for r in changed.select(BUCKET).distinct().collect()]
        old = store.read("groups", batch.schema, cells)
        same = old.withColumn(ID, identity(keys)).join(changed.select(identity(keys).alias(ID)), ID, "left_anti").drop(ID)
        store.commit(epoch_id, {"groups": store.write("groups", epoch_id, same.unionByName(changed))}, {"groups": cells})
        remove_path(spark, aside)

    return run_update_batches(df, publish, checkpoint, query_name, wait, "update")


def read_upserts(spark: SparkSession, path: str) -> DataFrame:
    """The committed groups of an upsert output."""
    return upsert_store(spark, path).read("groups").drop(BUCKET)


def run_update_batches(
    df: DataFrame, fn, checkpoint: str, query_name: str | None = None, wait: bool = True, mode: str = "append"
) -> StreamingQuery:
    """Arbitrary per-micro-batch logic (K5 and friends)."""

    def run(batch: DataFrame, epoch_id: int) -> None:
        apply_batch_conf(batch.sparkSession)
        fn(batch, epoch_id)

    w = df.writeStream.outputMode(mode).foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if query_name:
        w = w.queryName(query_name)
    q = w.start()
    return _check(q) if wait else q
