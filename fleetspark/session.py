"""Session helpers.

Library code never creates a session at import time. ``local_session`` is for
tests, the bench and the entry point; on a cluster the caller brings its own
session and only ``checkpoint_root`` is consulted.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Settings every session of ours wants, cluster or local.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only on a measured size: no broadcast from compressed-file
    # estimates at planning time; AQE converts a join to broadcast when the
    # materialised side is below 32 MB. Constant lookup tables use explicit
    # broadcast hints (their size is fixed by construction).
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    # Split any partition of a skewed join above 4x the median and 64 MB.
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Streaming state off the heap, with incremental (changelog) checkpoints.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

CODEC_CONF = "spark.sql.parquet.compression.codec"

# Settings of the session that a micro-batch has to itself (a copy of its query's).
BATCH_CONF = {
    # A statement's shuffle files go when it ends, not when the driver next happens to collect its heap.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    CODEC_CONF: "zstd",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "fleetspark") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.streaming.forceDeleteTempCheckpointLocation", "true")
    )
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_base_conf(spark)
    return spark


def apply_base_conf(spark: SparkSession) -> None:
    """Our settings where the session has none of its own; what the cluster or the caller set stays."""
    _set_missing(spark, BASE_CONF)


def apply_batch_conf(spark: SparkSession) -> None:
    """The same for the session of a micro-batch."""
    _set_missing(spark, BATCH_CONF)


def _set_missing(spark: SparkSession, conf: dict[str, str]) -> None:
    given = spark.conf.getAll
    for k, v in conf.items():
        if k not in given:
            spark.conf.set(k, v)


def table_codec(spark: SparkSession) -> str:
    """How stored tables are compressed, where no micro-batch of ours writes them."""
    return spark.conf.getAll.get(CODEC_CONF, BATCH_CONF[CODEC_CONF])


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and materialised intermediate tables.

    Read from ``spark.checkpoint.dir`` (the cluster names a shared, durable
    folder there). Only when it is unset on a local master -- tests -- do we
    pick a fresh folder under the system temp dir and record it in the session
    so every later caller sees the same root; on a cluster that is an error,
    because executors don't share such a folder.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a shared folder on master {master}")
        root = tempfile.mkdtemp(prefix="fleetspark-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, root)
        spark.sparkContext.setCheckpointDir(root)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the checkpoint root (never reused)."""
    root = checkpoint_root(spark)
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def _hadoop(spark: SparkSession, path: str):
    """The file system of a path and the path, as Hadoop objects."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, at = _hadoop(spark, path)
    return fs.exists(at)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none if there is no such folder."""
    fs, at = _hadoop(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []


def files_in(spark: SparkSession, path: str) -> dict[str, tuple[str, int]]:
    """Path and time of change (in milliseconds) of what a folder holds, by its URI: what ``_metadata.file_path`` shows, where
    an empty host may be left out, as it is here."""
    fs, at = _hadoop(spark, path)
    found = fs.listStatus(at) if fs.exists(at) else []
    return {s.getPath().toUri().toString().replace(":///", ":/"): (s.getPath().toString(), s.getModificationTime()) for s in found}


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete what this library wrote or took over and no longer needs."""
    fs, at = _hadoop(spark, path)
    fs.delete(at, True)


def size_for_data(spark: SparkSession, shuffle_bytes: int, total_cores: int, partition_bytes: int = 128 << 20) -> int:
    """Cluster sizing from the data volume, not a fixed number.

    * scan splits of ``partition_bytes`` (``spark.sql.files.maxPartitionBytes``);
    * initial shuffle partitions = shuffle bytes / ``partition_bytes``, at least
      2 x cores -- AQE then coalesces small ones to the advisory
      size and splits skewed ones, so this is an upper bound that keeps every
      reducer's input near ``partition_bytes`` (fits executor memory, spills
      gracefully).

    Stateful streams fix their partition count at first start (it is stored in
    the checkpoint), so call this before starting them. Returns the count.
    """
    n = max(2 * total_cores, -(-shuffle_bytes // partition_bytes))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(partition_bytes))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(partition_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    return n
