import random

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetspark.operators import scd
from fleetspark.operators.sequence import with_neighbor
from tests.conftest import rows

SNAP = "vehicle_id string, snapshot_date string, driver string, route string, is_active boolean, last_change_type string"


def _hist(spark, data, **kw):
    df = spark.createDataFrame(data, SNAP)
    return scd.scd2(df, ["vehicle_id"], "snapshot_date", **kw)


def test_tracked_history_a_b_a(spark):
    data = [
        ("T1", "05-01", "d1", "r", True, None),
        ("T1", "05-02", "d1", "r", True, None),
        ("T1", "05-03", "d2", "r", True, "driver"),
        ("T1", "05-04", "d1", "r", True, "driver"),
    ]
    h = _hist(spark, data, track_except=["snapshot_date", "last_change_type"])
    assert rows(h, "driver", "__START_AT", "__END_AT") == [
        ("d1", "05-01", "05-03"), ("d1", "05-04", None), ("d2", "05-03", "05-04")
    ]
    # all columns tracked: every snapshot opens a version
    assert _hist(spark, data).count() == 4


def test_null_values_compare_equal(spark):
    data = [("T2", "05-01", "x", None, True, None), ("T2", "05-02", "x", None, True, None)]
    h = _hist(spark, data, track_except=["snapshot_date", "last_change_type"])
    assert rows(h, "__START_AT", "__END_AT") == [("05-01", None)]
    assert _hist(spark, data).count() == 2


def test_inactive_is_a_value(spark):
    data = [("T3", "05-01", "d", "r", True, None), ("T3", "05-02", "d", "r", False, None)]
    h = _hist(spark, data, track_except=["snapshot_date", "last_change_type"])
    cur = scd.current_versions(h).collect()
    assert len(cur) == 1 and cur[0]["is_active"] is False and cur[0]["__START_AT"] == "05-02"


def test_late_snapshot_reopens(spark):
    data = [("T4", "05-01", "d1", "r", True, None), ("T4", "05-03", "d1", "r", True, None), ("T4", "05-02", "d2", "r", True, None)]
    h = _hist(spark, data, track_except=["snapshot_date", "last_change_type"])
    assert rows(h, "driver", "__START_AT") == [("d1", "05-01"), ("d1", "05-03"), ("d2", "05-02")]


def test_same_sequence_twice(spark):
    same = [("T5", "05-01", "d1", "r", True, None)] * 2
    assert _hist(spark, same).count() == 1
    differ = [("T5", "05-01", "d1", "r", True, None), ("T5", "05-01", "d9", "r", True, None)]
    h = _hist(spark, differ).collect()
    assert len(h) == 1 and h[0]["driver"] == "d9"  # greatest row wins


def test_null_sequence_rejected(spark):
    data = [("T6", None, "d1", "r", True, None), ("T6", "05-01", "d1", "r", True, None)]
    assert _hist(spark, data).count() == 1


def test_change_type_only_differs(spark):
    data = [("T7", "05-01", "d1", "r", True, "a"), ("T7", "05-02", "d1", "r", True, "b")]
    assert _hist(spark, data, track_except=["snapshot_date", "last_change_type"]).count() == 1
    assert _hist(spark, data).count() == 2


def test_scd1_latest(spark):
    data = [("T1", "05-01", "d1", "r", True, None), ("T1", "05-02", "d2", "r", True, None), ("T2", "05-01", "x", "r", True, None)]
    df = spark.createDataFrame(data, SNAP)
    assert rows(scd.scd1(df, ["vehicle_id"], "snapshot_date"), "vehicle_id", "driver") == [("T1", "d2"), ("T2", "x")]


@settings(max_examples=15, deadline=None)
@given(
    st.lists(
        st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 400), st.one_of(st.none(), st.integers(0, 9))),
        min_size=1, max_size=40, unique_by=lambda x: (x[0], x[1]),
    ),
    st.booleans(),
)
def test_chunked_neighbor_equals_plain_window(spark, data, ignore_nulls):
    recs = [(i, k, t, v) for i, (k, t, v) in enumerate(data)]
    pdf = pd.DataFrame(recs, columns=["id", "k", "t", "v"])
    df = spark.createDataFrame(recs, "id int, k string, t int, v int")
    got = with_neighbor(df, ["k"], ["t"], F.col("v"), "p", "prev", chunk=F.floor(F.col("t") / 50), ignore_nulls=ignore_nulls)
    got = {r["id"]: r["p"] for r in got.collect()}
    want = {}
    for _, g in pdf.groupby(pdf["k"].fillna("<null>")):
        last = None
        for _, r in g.sort_values("t").iterrows():
            want[r["id"]] = last
            v = None if pd.isna(r["v"]) else int(r["v"])
            if not ignore_nulls or v is not None:
                last = v
    assert got == want


@pytest.mark.parametrize("direction", ["prev", "next"])
def test_neighbour_with_null_order(spark, direction):
    data = [(0, "a", None), (1, "a", 5), (2, "a", 70), (3, "b", None), (4, "c", 3)]
    df = spark.createDataFrame(data, "id int, k string, t int")
    got = with_neighbor(df, ["k"], ["t"], F.col("id"), "n", direction, chunk=F.floor(F.col("t") / 10))
    want = {0: None, 1: 0, 2: 1, 3: None, 4: None} if direction == "prev" else {0: 1, 1: 2, 2: None, 3: None, 4: None}
    assert {r["id"]: r["n"] for r in got.collect()} == want


def test_chunked_next_equals_lead(spark):
    random.seed(7)
    data = [(i, random.choice("xyz"), t) for i, t in enumerate(random.sample(range(1000), 200))]
    df = spark.createDataFrame(data, "id int, k string, t int")
    got = with_neighbor(df, ["k"], ["t"], F.col("t"), "nxt", "next", chunk=F.floor(F.col("t") / 37))
    got = {r["id"]: r["nxt"] for r in got.collect()}
    want = {}
    for k in "xyz":
        ts = sorted((t, i) for i, kk, t in data if kk == k)
        for j, (t, i) in enumerate(ts):
            want[i] = ts[j + 1][0] if j + 1 < len(ts) else None
    assert got == want


def test_asof_join_honours_gaps_and_ties(spark):
    h = spark.createDataFrame([(1, 0, 10, "a"), (1, 20, None, "b"), (1, 20, None, "c")], "k int, __START_AT int, __END_AT int, label string")
    f = spark.createDataFrame([(i, 1, t) for i, t in enumerate([-1, 0, 9, 10, 15, 20, 99, None])], "fid int, k int, t int")
    for width in (1000, 7):
        got = scd.asof_join(f, h, "k", "k", "t", ["label"], chunk=F.floor(F.col("_t") / width)).orderBy("fid").collect()
        assert [r["label"] for r in got] == [None, "a", "a", None, None, "c", "c", None]


def test_asof_join_matches_brute_force(spark):
    random.seed(3)
    hist_rows, facts = [], []
    for k in range(4):
        starts = sorted(random.sample(range(0, 500), 6))
        for s in starts:
            hist_rows.append((k, s, f"v{k}-{s}"))
    for i in range(120):
        facts.append((i, random.choice([0, 1, 2, 3, 9, None]), random.choice([None, *range(0, 520, 3)])))
    h = spark.createDataFrame(hist_rows, "vehicle_id int, __START_AT int, label string")
    w = Window.partitionBy("vehicle_id").orderBy("__START_AT")
    h = h.withColumn("__END_AT", F.lead("__START_AT").over(w))
    f = spark.createDataFrame(facts, "fid int, vehicle_id int, t int")
    got = scd.asof_join(f, h, "vehicle_id", "vehicle_id", "t", ["label"], chunk=F.floor(F.col("_t") / 100))
    got = {r["fid"]: r["label"] for r in got.collect()}
    want = {}
    for fid, k, t in facts:
        cands = [(s, lab) for kk, s, lab in hist_rows if kk == k and k is not None and t is not None and s <= t]
        want[fid] = max(cands)[1] if cands else None
    assert got == want
