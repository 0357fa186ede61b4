import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fleetspark.operators import joins
from fleetspark.plans import gold, silver
from tests.conftest import rows

MAN = "manifest_id string, shipment_date string, vehicle_id string, route_name string, customer_name string, destination_city string, package_count int, total_weight_kg double, is_cold_chain boolean, priority string"
INV = "invoice_id string, manifest_id string, amount_inr double, payment_status string"


def _man(spark, ids):
    return spark.createDataFrame([(m, "2026-05-01", "TRK001", "R", "c", "x", 1, 1.0, False, "standard") for m in ids], MAN)


def test_manifest_invoice_left_join(spark):
    m = _man(spark, ["M1", "M2", "M3", "M4", None])
    i = spark.createDataFrame(
        [("I1", "M1", 100.0, "paid"), ("I3a", "M3", 40.0, "paid"), ("I3b", "M3", 60.0, "paid"),
         ("I4", "M4", None, "pending"), ("IX", None, 5.0, "paid")], INV)
    out = silver.shipment_invoice_silver(m, i)
    assert rows(out, "manifest_id", "invoice_id", "is_invoiced") == [
        ("M1", "I1", True), ("M2", None, False), ("M3", "I3a", True), ("M3", "I3b", True),
        ("M4", "I4", True), (None, None, False),
    ]
    rev = gold.daily_revenue_gold(out.where(F.col("manifest_id").isin("M1", "M2", "M3")))
    assert rows(rev, "revenue") == [(200.0,)]
    rev4 = gold.daily_revenue_gold(out.where(F.col("manifest_id") == "M4")).collect()
    assert len(rev4) == 1 and rev4[0]["revenue"] is None


def _ts(s):
    return dt.datetime(2026, 5, 1, 10, 0, 0) + dt.timedelta(seconds=s)


GPS = "vehicle_id string, trip_id string, event_timestamp timestamp, lat double, lon double, speed_kmph double, heading string, route_name string, distance_traveled_km double"
SEN = "vehicle_id string, trip_id string, event_timestamp timestamp, engine_temp_c double, fuel_level_litres double, cargo_temp_c double, anomaly_flag string, is_critical_anomaly boolean"


def _gps(spark, data):
    return spark.createDataFrame([(v, t, _ts(s), 19.0, 73.0, 50.0, "N", "R", d) for v, t, s, d in data], GPS)


def _sen(spark, data):
    return spark.createDataFrame([(v, t, _ts(s), 90.0, f, None, None, False) for v, t, s, f in data], SEN)


def test_interval_join_bounds(spark):
    g = _gps(spark, [("V", "A", 0, 0.0)])
    s = _sen(spark, [("V", "A", -30, 1.0), ("V", "A", 30, 2.0), ("V", "A", -30.001, 3.0), ("V", "A", 30.001, 4.0),
                     ("V", "B", 0, 5.0), ("V", None, 0, 6.0)])
    out = gold.live_fleet_status_gold(g, s, 30)
    assert rows(out, "fuel_level_litres") == [(1.0,), (2.0,)]


def test_interval_join_null_trip_never_matches(spark):
    g = _gps(spark, [("V", None, 0, 0.0)])
    s = _sen(spark, [("V", None, 0, 1.0)])
    assert gold.live_fleet_status_gold(g, s, 30).count() == 0


def test_interval_join_equals_brute_force(spark):
    random.seed(11)
    g = [("V", random.choice("AB"), random.randint(0, 3000), 0.0) for _ in range(150)]
    s = [("V", random.choice("AB"), random.randint(0, 3000), float(i)) for i in range(150)]
    out = gold.live_fleet_status_gold(_gps(spark, g), _sen(spark, s), 30)
    want = sorted(
        ((gt, _ts(gs), float(f)) for _, gt, gs, _ in g for _, st, ss, f in s if gt == st and abs(gs - ss) <= 30),
        key=repr,
    )
    assert rows(out, "trip_id", "event_timestamp", "fuel_level_litres") == want


def test_nearest_reading_ties_take_earlier(spark):
    g = _gps(spark, [("V", "A", 0, 0.0)])
    s = _sen(spark, [("V", "A", -10, 1.0), ("V", "A", 10, 2.0), ("V", "A", 25, 3.0)])
    out = gold.live_fleet_status_nearest(g, s, 30).collect()
    assert len(out) == 1 and out[0]["fuel_level_litres"] == 1.0


def test_fuel_eager_aggregation_equals_pairs(spark):
    g = _gps(spark, [("V1", "X", 0, 0.0), ("V1", "X", 60, 12.0), ("V2", "X", 0, 3.0), ("V1", "Y", 0, 1.0)])
    s = _sen(spark, [("V1", "X", 0, 100.0), ("V1", "X", 10, 90.0), ("V1", "X", 20, 95.0), ("V3", "Z", 0, 50.0),
                     ("V2", "X", 5, 80.0), ("V1", "W", 0, None)])
    s = s.union(_sen(spark, [("V1", "Y", 0, 10.0)]).withColumn("fuel_level_litres", F.lit(None).cast("double")))
    got = {r["trip_id"]: tuple(r)[1:] for r in gold.fuel_cost_efficiency_gold(s, g).collect()}
    # brute force: aggregate the n*m pairs of the literal plan
    sp = [(r["vehicle_id"], r["trip_id"], r["fuel_level_litres"]) for r in s.collect()]
    gp = [(r["vehicle_id"], r["trip_id"], r["distance_traveled_km"]) for r in g.collect()]
    want = {}
    for sv, st, f in sp:
        for gv, gt, d in gp:
            if sv == gv and st == gt and st is not None:
                want.setdefault(st, []).append((f, d))
    def mx(xs, fn):
        xs = [x for x in xs if x is not None]
        return fn(xs) if xs else None
    for t, pairs in want.items():
        fs, ds = [p[0] for p in pairs], [p[1] for p in pairs]
        a, b, c, d = mx(fs, max), mx(fs, min), mx(ds, max), mx(ds, min)
        want[t] = (a, b, c, d, None if a is None else a - b, c - d)
    assert got == want
    assert got["X"][4] == 20.0 and got["X"][5] == 12.0
    assert got["Y"][0] is None


def test_left_join_keep_all_plan_has_no_outer_join(spark):
    m = _man(spark, ["M1"])
    i = spark.createDataFrame([("I1", "M1", 1.0, "paid")], INV)
    out = joins.left_join_keep_all(m, i, "manifest_id", "manifest_id", ["manifest_id"], ["invoice_id"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" not in plan and "LeftAnti" in plan


def test_interval_join_needs_a_positive_bound(spark):
    df = spark.createDataFrame([], "k int, t timestamp")
    with pytest.raises(ValueError):
        joins.interval_join(df, df, ["k"], "t", "t", 0, [F.col("g.k")])
