import datetime as dt
import math

from pyspark.sql import functions as F

from fleetspark.functions import scalar as S
from fleetspark.plans import gold
from fleetspark.sources.ingest import read_landing_batch
from fleetspark.schemas import schema


def test_parse_event_time(spark):
    df = spark.createDataFrame(
        [("2026-05-01T10:00:00.123456+00:00",), ("2026-05-01T10:00:00+00:00",), ("garbage",), (None,)], "s string"
    )
    got = [r["t"] for r in df.select(S.parse_event_time("s").cast("timestamp_ntz").alias("t")).collect()]
    assert got == [dt.datetime(2026, 5, 1, 10, 0, 0, 123456), dt.datetime(2026, 5, 1, 10, 0), None, None]


def test_status_order_lookup(spark):
    df = spark.createDataFrame(
        [("created",), ("picked_up",), ("in_transit",), ("out_for_delivery",), ("delivered",), ("lost",), (None,)], "s string"
    )
    got = [r["o"] for r in df.select(S.status_order("s").alias("o")).collect()]
    assert got == [0, 1, 2, 3, 4, None, None]


def test_money_is_summed_as_it_is(spark):
    ship = "shipment_date string, route_name string, priority string, is_invoiced boolean, amount_inr double"
    rows = [("d", "r", k, True, v) for k, vs in
            {"sub": [0.004] * 3, "nan": [1.0, float("nan")], "big": [1e17, 1.0], "null": [None], "some": [None, 2.5]}.items() for v in vs]
    got = {r["priority"]: r["revenue"] for r in gold.daily_revenue_gold(spark.createDataFrame(rows, ship)).collect()}
    assert abs(got["sub"] - 0.012) < 1e-12 and math.isnan(got["nan"]) and got["big"] == 1e17 and got["null"] is None and got["some"] == 2.5


def test_csv_booleans_empty_and_bad_int(spark, tmp_path):
    p = tmp_path / "master"
    p.mkdir()
    (p / "a.csv").write_text(
        "snapshot_date,vehicle_id,license_plate,vehicle_type,driver_id,driver_name,driver_phone,driver_license_no,home_route,is_active,last_change_type\n"
        "2026-05-01,TRK001,MH01,medium_truck,D1,Asha,1,L1,R,True,\n"
        "2026-05-02,TRK001,MH01,medium_truck,D1,Asha,1,L1,R,False,driver_change\n"
    )
    got = read_landing_batch(spark, str(p), "csv", schema("driver_vehicle_master")).orderBy("snapshot_date").collect()
    assert [r["is_active"] for r in got] == [True, False]
    assert got[0]["last_change_type"] is None
    m = tmp_path / "maint"
    m.mkdir()
    (m / "a.csv").write_text(
        "log_id,service_date,vehicle_id,issue_type,cost_inr,odometer_km,service_center\nL1,2026-05-01,T,brake,10.5,bad,C\n"
    )
    r = read_landing_batch(spark, str(m), "csv", schema("maintenance_logs")).collect()[0]
    assert r["odometer_km"] is None and r["cost_inr"] == 10.5


def test_size_for_data(spark):
    from fleetspark.session import size_for_data

    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_for_data(spark, 100 * (1 << 40), 8000) == 100 * (1 << 40) // (128 << 20)
        assert size_for_data(spark, 10 << 30, 8000) == 16_000
        assert size_for_data(spark, 1 << 30, 4) == 8
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(128 << 20)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
