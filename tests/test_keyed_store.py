"""Committed stores: incremental history by parts, upserts of changed groups, replays."""

import os
import random

import pytest

from fleetspark.operators import scd
from fleetspark.streaming import runner, scd_stream
from fleetspark.streaming.keyed_store import KeyedStore
from tests.conftest import rows

SNAPSHOT = "snapshot_date string, vehicle_id string, driver_name string, note string"
SHOWN = ["snapshot_date", "vehicle_id", "driver_name", "note", "__START_AT", "__END_AT"]


class History:
    """Drops of snapshots, one micro-batch each, into an incremental history."""

    def __init__(self, spark, tmp_path, ddl=SNAPSHOT, **more):
        self.spark, self.ddl = spark, ddl
        self.land, self.target, self.checkpoint = (str(tmp_path / x) for x in ("land", "history", "checkpoint"))
        self.more = {"track_except": ["snapshot_date", "note"], "buckets": 2, **more}

    def drop(self, snapshots):
        self.spark.createDataFrame(snapshots, self.ddl).coalesce(1).write.mode("append").parquet(self.land)
        stream = self.spark.readStream.schema(self.ddl).parquet(self.land)
        scd_stream.scd2_incremental(self.spark, stream, self.target, self.checkpoint, ["vehicle_id"], "snapshot_date", **self.more)

    def check(self):
        more = {k: v for k, v in self.more.items() if k != "buckets"}
        whole = scd.scd2(self.spark.read.parquet(self.land), ["vehicle_id"], "snapshot_date", **more)
        assert rows(scd_stream.read_history(self.spark, self.target), *SHOWN) == rows(whole, *SHOWN)

    def written(self, table):
        return KeyedStore(self.spark, self.target, scd_stream.TABLES).live(table)


def test_late_snapshots_in_any_order(spark, tmp_path):
    """Five drops in random order: NULL keys, values and sequences, conflicting and repeated snapshots, returning values."""
    rng = random.Random(3)
    history = History(spark, tmp_path)
    for _ in range(5):
        history.drop([
            (rng.choice([f"2026-{rng.randint(1, 9):02d}-{rng.randint(1, 28):02d}"] * 12 + [None]), rng.choice(["T1", "T2", "T3", None]), rng.choice("ABB") if rng.random() < 0.9 else None, rng.choice("xy"))
            for _ in range(rng.randint(1, 25))
        ])
        history.check()


def test_every_snapshot_a_version(spark, tmp_path):
    history = History(spark, tmp_path, track_except=None)
    history.drop([("2026-03-01", "T1", "A", "x"), ("2026-01-05", "T1", "A", "x")])
    history.drop([("2026-02-01", "T1", "A", "x"), ("2026-03-01", "T1", "B", "x")])
    history.check()


def test_work_follows_the_batch_not_the_history(spark, tmp_path):
    """Two years of 40 keys; a late snapshot rewrites its part and the one whose version ends there, no other cell."""
    history = History(spark, tmp_path, buckets=8)
    month = lambda i: f"{2024 + i // 12}-{i % 12 + 1:02d}"
    history.drop([(f"{month(i)}-{d:02d}", f"T{k}", f"driver {i // 6}", "x") for i in range(24) for d in (1, 15) for k in range(40)])
    before = history.written("history"), history.written("snapshots")
    history.drop([(f"{month(20)}-07", "T5", "stand-in", "x")])
    history.check()
    changed = [{c for c, e in history.written(t).items() if old.get(c) != e} for t, old in zip(("history", "snapshots"), before, strict=True)]
    # the version before starts in month 18, the stand-in's and its successor's in month 20
    assert len(changed[0]) == 2 and len(changed[1]) == 1 and len(before[1]) == 8 * 24
    store = KeyedStore(spark, history.target, scd_stream.TABLES)
    read = sum(store.read(t, cells=c).count() for t, c in zip(("history", "snapshots"), changed, strict=True))
    assert read <= 60  # of 1921 snapshots
    # a part of a later month opens a version once a late snapshot makes its first row a change
    history.drop([(f"{month(20)}-28", "T6", "other", "x")])
    history.check()


def test_a_replayed_epoch_changes_nothing(spark, tmp_path):
    history = History(spark, tmp_path)
    history.drop([("2026-01-01", "T1", "A", "x"), ("2026-02-01", "T1", "B", "x")])
    first = history.written("history")
    for f in ("0", ".0.crc"):  # the query died between our commit and its own
        os.remove(f"{history.checkpoint}/commits/{f}")
    history.drop([("2026-01-15", "T1", "C", "x")])
    assert {e for e in first.values()} == {0}
    history.check()


def test_upserts_replace_changed_groups_only(spark, tmp_path):
    land, out, checkpoint = (str(tmp_path / x) for x in ("land", "out", "checkpoint"))
    ddl = "k string, v int"

    def drop(data):
        spark.createDataFrame(data, ddl).write.mode("append").parquet(land)
        sums = spark.readStream.schema(ddl).parquet(land).groupBy("k").sum("v").withColumnRenamed("sum(v)", "total")
        runner.run_upsert(sums, ["k"], out, checkpoint, buckets=8)
        return rows(runner.read_upserts(spark, out), "k", "total")

    everything = [(f"k{i}", i) for i in range(40)] + [(None, 7)]
    assert drop(everything) == sorted([(k, v) for k, v in everything], key=repr)
    groups = lambda: KeyedStore(spark, out, {"groups": [runner.BUCKET]})
    before = groups().live("groups")
    assert drop([("k3", 100), (None, 1)]) == sorted([(k, v + 100 * (k == "k3") + (k is None)) for k, v in everything], key=repr)
    after = groups().live("groups")
    assert len(before) == 8 and sum(after[c] != e for c, e in before.items()) <= 2
    drop([("k3", 1)])
    store = groups()
    # what the last commit but one replaced is gone
    assert sorted(os.listdir(f"{out}/commits")) and all(os.path.isdir(store._path("groups", e, c)) for c, e in store.live("groups").items())
    held = sum(os.path.isdir(store._path("groups", e, c)) for c in after for e in (0, 1, 2))
    assert held <= 8 + 3


def test_commits_are_atomic(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "store"), {"a": ["p"], "b": []})
    one = spark.createDataFrame([("x", 1), ("y", 2)], "p string, n int")
    assert not store.committed(0) and store.live("a") == {} and store.read("a", one.drop("p").schema).count() == 0
    written = {"a": store.write("a", 0, one), "b": store.write("b", 0, one.drop("p"))}
    assert store.live("a") == {}  # nothing is seen before the commit
    store.commit(0, written)
    assert store.committed(0) and not store.committed(1)
    assert rows(store.read("a"), "p", "n") == [("x", 1), ("y", 2)] and rows(store.read("b")) == [(1,), (2,)]
    store.commit(1, {"a": store.write("a", 1, one.where("p = 'x'").selectExpr("p", "n + 10 AS n"))}, {"a": [("y",)]})
    assert rows(store.read("a"), "p", "n") == [("x", 11)] and rows(store.read("b")) == [(1,), (2,)]
    assert store.read("a", cells=[("y",)]).count() == 0
