import datetime as dt
import json
import os
import time

from pyspark.sql import functions as F

from fleetspark.plans import gold, silver
from fleetspark.schemas import schema
from fleetspark.sources import ingest
from fleetspark.streaming import runner
from tests.conftest import rows


def _drop_json(dirpath, idx, recs):
    os.makedirs(dirpath, exist_ok=True)
    p = os.path.join(dirpath, f"part-{idx:03d}.json")
    with open(p, "w") as f:
        for r in recs:
            f.write(json.dumps(r) + "\n")
    t = time.time() - 1000 + idx  # fixes the order files are picked up
    os.utime(p, (t, t))


def _gps(trip, ts):
    return {"event_type": "gps", "trip_id": trip, "vehicle_id": "V", "driver_id": "D", "timestamp": ts,
            "lat": 19.0, "lon": 73.0, "speed_kmph": 50.0, "heading": "N", "distance_traveled_km": 1.0,
            "route_name": "R"}


def _iso(h, m, s=0, us=0):
    return dt.datetime(2026, 5, 1, h, m, s, us).isoformat() + "+00:00"


def test_dedup_and_late_rows(spark, tmp_path):
    land = str(tmp_path / "gps")
    drops = [
        [_gps("A", _iso(10, 0)), _gps("A", _iso(10, 0)), _gps(None, _iso(10, 0)), _gps(None, _iso(10, 0)), _gps("A", None)],
        [_gps("A", _iso(10, 10))],
        [_gps("A", _iso(10, 0, 30))],
        [_gps("A", _iso(12, 30))],
        [_gps("A", _iso(13, 30))],
        [_gps("B", _iso(11, 0))],
    ]
    for i, d in enumerate(drops):
        _drop_json(land, i, d)
    stream = ingest.landing_stream(spark, land, "json", schema("gps_events"), {"maxFilesPerTrigger": "1"})
    out = silver.gps_events_silver(stream)
    path, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    runner.run_append(out, path, ck)
    got = rows(spark.read.parquet(path).select("trip_id", F.col("event_timestamp").cast("timestamp_ntz").alias("t")))
    t = lambda h, m, s=0: dt.datetime(2026, 5, 1, h, m, s)
    assert ("A", t(10, 0)) in got and (None, t(10, 0)) in got
    # a row without a time never gets to the dedup: it is in the untimed quarantine instead
    assert ("A", None) not in got
    batch = spark.read.schema(schema("gps_events")).json(land)
    assert rows(silver.EVENT_TIME_RULES.quarantine(silver.with_event_time(batch)), "trip_id", "_failed_rules") == [("A", ["valid_event_time"])]
    assert got.count(("A", t(10, 0))) == 1 and got.count((None, t(10, 0))) == 1
    assert ("A", t(10, 10)) in got and ("A", t(12, 30)) in got and ("A", t(13, 30)) in got
    assert ("B", t(11, 0)) not in got  # behind the watermark: dropped as late


def _delivery(trip, ts, status="in_transit"):
    return {"event_type": "delivery", "trip_id": trip, "vehicle_id": "V", "timestamp": ts, "status": status,
            "location_city": "Pune"}


def test_tumbling_window_edges_and_open_last_window(spark, tmp_path):
    land = str(tmp_path / "del")
    _drop_json(land, 0, [
        _delivery("a", _iso(10, 0)), _delivery("b", _iso(10, 59, 59, 999999)), _delivery("c", _iso(11, 0)),
        _delivery("d", _iso(12, 30)), _delivery("e", _iso(12, 31), "exception"),
    ])
    stream = ingest.landing_stream(spark, land, "json", schema("delivery_events"))
    out = gold.delivery_performance_gold(silver.delivery_events_silver(stream))
    path, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    runner.run_append(out, path, ck)
    got = rows(spark.read.parquet(path).select(F.col("window_start").cast("timestamp_ntz").alias("w"), "event_count"))
    assert got == [(dt.datetime(2026, 5, 1, 10, 0), 2), (dt.datetime(2026, 5, 1, 11, 0), 1)]
    # batch form emits every window, the open one too
    batch = spark.read.schema(schema("delivery_events")).json(land)
    assert gold.delivery_performance_gold(silver.delivery_events_silver(batch)).count() == 3


def test_ingest_restart_is_exactly_once(spark, tmp_path):
    land, table, ck = str(tmp_path / "land"), str(tmp_path / "bronze"), str(tmp_path / "ck")
    _drop_json(land, 0, [_gps("A", _iso(10, 0)), _gps("A", _iso(10, 1))])
    ingest.ingest_source(spark, "gps_events", land, table, ck)
    ingest.ingest_source(spark, "gps_events", land, table, ck)
    b = spark.read.parquet(table)
    assert b.count() == 2
    assert set(b.columns) >= {"_ingested_at", "_source_file", "_source_name"}
    assert b.where(F.col("_source_file").endswith("part-000.json")).count() == 2
    _drop_json(land, 1, [_gps("A", _iso(10, 2))])
    ingest.ingest_source(spark, "gps_events", land, table, ck)
    assert spark.read.parquet(table).count() == 3


def test_stream_static_join_is_stale_by_design(spark, tmp_path):
    man_land, inv_path = str(tmp_path / "man"), str(tmp_path / "inv")
    inv_schema = schema("invoices")
    spark.createDataFrame([("I0", "M0", "d", "c", 1.0, "paid")], inv_schema).write.parquet(inv_path)

    def man(mid):
        return {"manifest_id": mid, "shipment_date": "2026-05-01", "vehicle_id": "V", "route_name": "R",
                "customer_name": "c", "destination_city": "x", "package_count": 1, "total_weight_kg": 1.0,
                "is_cold_chain": False, "priority": "standard"}

    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")

    def run():
        stream = ingest.landing_stream(spark, man_land, "json", schema("shipment_manifests"))
        runner.run_append(silver.shipment_invoice_silver(stream, spark.read.parquet(inv_path)), out, ck)

    _drop_json(man_land, 0, [man("M5")])
    run()
    spark.createDataFrame([("I5", "M5", "d", "c", 9.0, "paid")], inv_schema).write.mode("append").parquet(inv_path)
    _drop_json(man_land, 1, [man("M6")])
    run()
    streamed = rows(spark.read.parquet(out), "manifest_id", "is_invoiced")
    assert streamed == [("M5", False), ("M6", False)]
    batch = silver.shipment_invoice_silver(
        spark.read.schema(schema("shipment_manifests")).json(man_land), spark.read.parquet(inv_path)
    )
    assert rows(batch, "manifest_id", "is_invoiced") == [("M5", True), ("M6", False)]


def test_complete_mode_sink_overwrites(spark, tmp_path):
    land = str(tmp_path / "maint")
    os.makedirs(land)
    hdr = "log_id,service_date,vehicle_id,issue_type,cost_inr,odometer_km,service_center\n"
    with open(os.path.join(land, "a.csv"), "w") as f:
        f.write(hdr + "L1,2026-05-01,T1,brake,10.0,100,C\nL2,2026-05-01,T1,tyre,5.0,100,C\n")
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")

    def run():
        stream = ingest.landing_stream(spark, land, "csv", schema("maintenance_logs"))
        runner.run_complete(gold.maintenance_costs(silver.maintenance_logs_silver(stream)), out, ck)

    run()
    with open(os.path.join(land, "b.csv"), "w") as f:
        f.write(hdr + "L3,2026-05-02,T1,oil,2.5,120,C\nL4,2026-05-02,T2,oil,0,120,C\n")
    run()
    assert rows(runner.read_complete(spark, out)) == [("T1", 17.5, 3)]
    # a rewrite that has written its epoch but not committed it isn't seen
    spark.range(3).write.parquet(f"{out}/data/result/_epoch=99")
    assert rows(runner.read_complete(spark, out)) == [("T1", 17.5, 3)]
