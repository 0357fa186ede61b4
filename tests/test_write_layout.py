"""What micro-batches write follows buckets and cells, not tasks."""

from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F

from fleetspark.streaming import bucketed, runner, scd_stream
from tests.conftest import rows


def _landed(spark, df, path, files):
    df.repartition(files).write.parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


def _files(folder):
    found = glob.glob(f"{folder}/**/part-*.parquet", recursive=True)
    return len(found), len({f.rpartition("/")[0] for f in found})


def test_fill_writes_a_file_a_bucket(spark, tmp_path):
    df = spark.range(4000).select(F.when(F.col("id") % 40 != 0, F.col("id") % 500).alias("k"), F.col("id").alias("v"))
    path = str(tmp_path / "copy")
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # a task a file
    try:
        bucketed.fill(_landed(spark, df, str(tmp_path / "in"), 6), "k", path, str(tmp_path / "ckpt"), buckets=16)
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    files, folders = _files(path)
    assert folders == 16 and files == 16
    back = spark.read.parquet(path)
    assert rows(back, "k", "v") == rows(df.where("k is not null"), "k", "v")


@pytest.fixture
def no_coalescing(spark):
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "false")
    yield
    spark.conf.set(conf, before)


def test_scd2_cells_are_a_file_each(spark, tmp_path, no_coalescing, monkeypatch):
    calls = []
    plain = scd_stream.with_neighbor
    monkeypatch.setattr(scd_stream, "with_neighbor", lambda *a, **k: calls.append(a) or plain(*a, **k))
    df = spark.range(3000).select((F.col("id") % 60).alias("k"), F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, cast(id % 20 as int))").alias("ts"), (F.col("id") % 7).alias("v"))
    target = str(tmp_path / "target")
    scd_stream.scd2_incremental(spark, _landed(spark, df, str(tmp_path / "in"), 6), target, str(tmp_path / "ckpt"), ["k"], "ts", track=["v"], buckets=8)
    for table in scd_stream.TABLES:
        files, folders = _files(f"{target}/data/{table}")
        assert folders == 8 and files == 8, table
    assert len(calls) == 2  # changes of the touched parts, once, and the ends of their versions


def test_upserted_buckets_are_a_file_each(spark, tmp_path, no_coalescing):
    df = spark.range(2000).select((F.col("id") % 300).alias("k"), F.col("id").alias("v"))
    stream = _landed(spark, df, str(tmp_path / "in"), 6).groupBy("k").agg(F.sum("v").alias("s"))
    target = str(tmp_path / "target")
    runner.run_upsert(stream, ["k"], target, str(tmp_path / "ckpt"), buckets=8)
    files, folders = _files(f"{target}/data/groups")
    assert folders == 8 and files == 8
    assert rows(runner.read_upserts(spark, target), "k", "s") == rows(df.groupBy("k").agg(F.sum("v").alias("s")), "k", "s")
