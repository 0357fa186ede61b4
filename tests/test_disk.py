"""What a job leaves on disk, and when it goes."""

from __future__ import annotations

import glob
import gzip
import os
import time

import pytest
from pyspark.sql import functions as F

from fleetspark.operators.expectations import ExpectationSet, expect_or_drop
from fleetspark.plans import jobs, stream_catalog
from fleetspark.session import BATCH_CONF, CODEC_CONF
from fleetspark.sources import ingest
from fleetspark.sources.tables import read_static
from fleetspark.streaming import bucketed, runner
from tests.conftest import rows

HEADER = "invoice_id,manifest_id,invoice_date,customer_name,amount_inr,payment_status\n"


def _shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (found.apply(i).getName() for i in range(found.size()))
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def _stream(spark, df, path):
    df.write.parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


def test_shuffle_files_go_with_their_statement(spark, tmp_path):
    df = spark.range(50_000).withColumn("k", F.col("id") % 50)
    left = set()

    def publish(batch, epoch_id):
        before = _shuffle_files(spark)
        batch.repartition(4, "k").write.parquet(str(tmp_path / "out"))
        until = time.time() + 15  # they are removed beside what runs next
        while (made := _shuffle_files(spark) - before) and time.time() < until:
            time.sleep(0.2)
        left.update(made)

    runner.run_update_batches(_stream(spark, df, str(tmp_path / "in")), publish, str(tmp_path / "ckpt"))
    assert not left
    assert not set(BATCH_CONF) & set(spark.conf.getAll)  # the caller's session is as it was


def _codecs(path):
    return {f.rsplit(".", 2)[1] for f in glob.glob(f"{path}/**/part-*.parquet", recursive=True)}


def test_stored_tables_are_compressed_well(spark, tmp_path):
    df = spark.range(100).select(F.col("id").cast("string").alias("k"), "id")
    os.makedirs(tmp_path / "json")
    (tmp_path / "json" / "a.json").write_text('{"x": 1}\n')

    def tables(name):
        at = lambda part: str(tmp_path / f"{name}-{part}")
        bucketed.fill(_stream(spark, df, at("in")), "k", at("copy"), at("ckpt"), buckets=2)
        ingest.ingest_source(spark, "a", str(tmp_path / "json"), at("bronze"), at("ckpt2"), fmt="json", schema=spark.range(1).withColumnRenamed("id", "x").schema)
        return _codecs(at("copy")) | _codecs(at("bronze"))

    assert tables("ours") == {"zstd"}
    spark.conf.set(CODEC_CONF, "gzip")
    try:
        assert tables("caller's") == {"gz"}
    finally:
        spark.conf.unset(CODEC_CONF)


def test_rows_kept_aside_before_a_join_go_after_it(spark, tmp_path, monkeypatch):
    seen = []
    plain = runner.write_once
    at = lambda part: str(tmp_path / part)
    monkeypatch.setattr(runner, "write_once", lambda df, folder: seen.append(os.listdir(at("counts__incoming"))) or plain(df, folder))
    rules = ExpectationSet([expect_or_drop("even", "id % 2 = 0")])
    publish = jobs.split_writer(rules, at("kept"), at("refused"), at("counts"), of_batch=rules.flagged)
    runner.run_update_batches(_stream(spark, spark.range(10), at("in")), publish, at("ckpt"))
    assert seen and all(s == ["0-flagged"] for s in seen)
    assert rows(read_static(spark, at("kept"))) == [(i,) for i in range(0, 10, 2)] and read_static(spark, at("refused")).count() == 5


def test_landed_files_are_compressed_and_bounded(spark, sf_small, tmp_path, monkeypatch):
    monkeypatch.setattr(stream_catalog, "LANDED_ROWS", 1000)
    stream_catalog._land(spark, sf_small, str(tmp_path), ["invoices"])
    files = glob.glob(f"{tmp_path}/invoices/part-*")
    lines = [gzip.open(f, "rt").read().splitlines() for f in files]
    assert len(files) > 1 and all(f.endswith(".csv.gz") for f in files)
    assert all(x[0] + "\n" == HEADER and len(x) <= 1001 for x in lines)
    assert sum(len(x) - 1 for x in lines) == stream_catalog.T.table(spark, sf_small, "lineitem").count()


def test_files_go_once_their_rows_are_stored(spark, tmp_path):
    land, bronze, ckpt = (str(tmp_path / x) for x in ("landing", "bronze", "ckpt"))
    os.makedirs(f"{land}/invoices")
    drop = lambda name, text: (tmp_path / "landing" / "invoices" / name).write_text(HEADER + text)
    left = lambda: sorted(f for f in os.listdir(f"{land}/invoices") if not f.startswith("."))
    run = lambda **more: ingest.ingest_batch_sources(spark, land, bronze, ckpt, ["invoices"], rescue=True, **more)["invoices"]
    drop("day 1+%.csv", "I1,M1,2026-05-01,Acme,1.0,paid\nI2\n")
    drop("empty.csv", "")
    run()
    assert left() == ["day 1+%.csv", "empty.csv"]  # they stay unless it is asked for
    drop("day2.csv", "I3,M1,2026-05-02,Acme,2.0,paid\n")
    table = run(purge=True)
    assert left() == ["empty.csv"]
    assert rows(read_static(spark, table), "invoice_id", "_corrupt_record") == [("I1", None), ("I2", "I2"), ("I3", None)]
    drop("day2.csv", "I4,M1,2026-05-03,Acme,3.0,paid\n")  # anew under a taken name: not read, so not deleted
    future = time.time() + 60
    os.utime(f"{land}/invoices/day2.csv", (future, future))
    run(purge=True)
    assert left() == ["day2.csv", "empty.csv"] and read_static(spark, table).count() == 3


@pytest.mark.parametrize("query", ["batch_job_rules", "batch_job_revenue"])
def test_the_batch_jobs_purge_what_they_landed(spark, tmp_path, monkeypatch, query):
    """What they landed themselves they need not keep."""
    asked = []

    def stop(spark, landing_root, lake_root, checkpoint_root, **more):
        asked.append(more)
        raise InterruptedError

    monkeypatch.setattr(jobs, "run_batch_job", stop)
    monkeypatch.setattr(stream_catalog, "_land", lambda *a: None)
    with pytest.raises(InterruptedError):
        stream_catalog.STREAM_QUERIES[query](spark, str(tmp_path))
    assert asked == [{"purge": True}]
