import json
import os
import time

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import pytest

from fleetspark.operators import scd
from fleetspark.plans import gold, silver
from fleetspark.schemas import schema
from fleetspark.sources import ingest
from fleetspark.sources.evolution import read_csv_evolving
from fleetspark.sources.tables import TableNames, read_static, read_stream
from fleetspark.streaming import bucketed, runner, scd_stream
from tests.conftest import rows


def _write(path, name, text, idx=0):
    os.makedirs(path, exist_ok=True)
    p = os.path.join(path, name)
    with open(p, "w") as f:
        f.write(text)
    t = time.time() - 1000 + idx
    os.utime(p, (t, t))


def test_batch_sources_to_bronze(spark, tmp_path):
    land = str(tmp_path / "landing")
    _write(f"{land}/shipment_manifests", "d1.json", json.dumps({
        "manifest_id": "MAN202605010001", "shipment_date": "2026-05-01", "vehicle_id": "TRK001",
        "route_name": "ROUTE_MUM_PUNE", "customer_name": "Acme", "destination_city": "Pune", "package_count": 3,
        "total_weight_kg": 120.5, "is_cold_chain": True, "priority": "express"}) + "\n")
    _write(f"{land}/invoices", "d1.csv",
           "invoice_id,manifest_id,invoice_date,customer_name,amount_inr,payment_status\n"
           "INVMAN202605010001,MAN202605010001,2026-05-01,Acme,1500.0,paid\n")
    _write(f"{land}/maintenance_logs", "d1.csv",
           "log_id,service_date,vehicle_id,issue_type,cost_inr,odometer_km,service_center\n"
           "MNT20260501TRK001,2026-05-01,TRK001, brake ,2500.0,42000, Pune Central \n")
    _write(f"{land}/driver_vehicle_master", "d1.csv",
           "snapshot_date,vehicle_id,license_plate,vehicle_type,driver_id,driver_name,driver_phone,driver_license_no,home_route,is_active,last_change_type\n"
           "2026-05-01,TRK001,MH01AB1234,medium_truck,D1,Asha,9876543210,MH0120110012345,ROUTE_MUM_PUNE,True,\n")
    names = TableNames(str(tmp_path / "lake"), "other")
    out = ingest.ingest_batch_sources(spark, land, names.path("bronze", "").rstrip("/"), str(tmp_path / "ck"))
    assert set(out) == {"shipment_manifests", "invoices", "maintenance_logs", "driver_vehicle_master"}
    counts = {r["table_name"]: r["row_count"] for r in ingest.table_counts(spark, out).collect()}
    assert counts == {k: 1 for k in out}
    m = spark.read.parquet(out["maintenance_logs"])
    assert silver.maintenance_logs_silver(m).collect()[0]["service_center"] == "Pune Central"
    assert m.collect()[0]["_source_name"] == "maintenance_logs"
    # the silver/gold chain runs on the bronze tables as streams
    man = read_stream(spark, out["shipment_manifests"])
    ship = silver.shipment_invoice_silver(man, spark.read.parquet(out["invoices"]))
    runner.run_complete(gold.daily_revenue_gold(ship), str(tmp_path / "rev"), str(tmp_path / "ck-rev"))
    assert rows(runner.read_complete(spark, str(tmp_path / "rev"))) == [("2026-05-01", "ROUTE_MUM_PUNE", "express", 1500.0)]


def test_table_names_and_missing_tables(spark, tmp_path):
    names = TableNames.from_session(spark, str(tmp_path))
    assert names.name("bronze", "gps_events") == "lake.bronze.gps_events"
    assert names.bronze_table("gps_events").endswith("/lake/bronze/gps_events")
    spark.range(3).write.parquet(str(tmp_path / "present"))
    got = {r["table_name"]: r["row_count"] for r in ingest.table_counts(
        spark, {"present": str(tmp_path / "present"), "absent": str(tmp_path / "absent")}).collect()}
    assert got == {"present": 3, "absent": None}
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception):  # only an absent table is tolerated
        ingest.table_counts(spark, {"broken": str(tmp_path / "broken")}).collect()


SNAP_COLS = ["snapshot_date", "vehicle_id", "driver_name"]


def test_incremental_scd2_absorbs_late_snapshot(spark, tmp_path):
    land, target, ck = str(tmp_path / "snaps"), str(tmp_path / "hist"), str(tmp_path / "ck")
    ddl = "snapshot_date string, vehicle_id string, driver_name string"
    spark.createDataFrame([("05-01", "T4", "d1"), ("05-03", "T4", "d1"), ("05-01", "T9", "x")], ddl).write.parquet(land)
    def run():
        stream = spark.readStream.schema(ddl).parquet(land)
        scd_stream.scd2_incremental(spark, stream, target, ck, ["vehicle_id"], "snapshot_date",
                                    track_except=["snapshot_date"], buckets=4)
    run()
    first = rows(scd_stream.read_history(spark, target).where("vehicle_id = 'T4'"), "driver_name", "__START_AT", "__END_AT")
    assert first == [("d1", "05-01", None)]
    spark.createDataFrame([("05-02", "T4", "d2")], ddl).write.mode("append").parquet(land)
    run()
    hist = scd_stream.read_history(spark, target)
    assert rows(hist.where("vehicle_id = 'T4'"), "driver_name", "__START_AT", "__END_AT") == [
        ("d1", "05-01", "05-02"), ("d1", "05-03", None), ("d2", "05-02", "05-03")
    ]
    assert rows(hist.where("vehicle_id = 'T9'"), "driver_name") == [("x",)]
    full = scd.scd2(spark.read.parquet(land), ["vehicle_id"], "snapshot_date", track_except=["snapshot_date"])
    assert rows(hist.select(*SNAP_COLS, "__START_AT", "__END_AT")) == rows(full.select(*SNAP_COLS, "__START_AT", "__END_AT"))


def test_stream_equals_batch_one_file_per_batch(spark, tmp_path):
    land = str(tmp_path / "sensor")
    for i in range(4):
        recs = [{"event_type": "sensor", "trip_id": f"T{j % 3}", "vehicle_id": "V", "timestamp": f"2026-05-01T10:{i:02d}:{j:02d}+00:00",
                 "engine_temp_c": 80.0 + j, "fuel_level_litres": 100.0 - j, "cargo_temp_c": None,
                 "anomaly_flag": "engine_overheat" if j % 4 == 0 else None} for j in range(10)]
        _write(land, f"s{i}.json", "\n".join(json.dumps(r) for r in recs) + "\n", i)
    stream = ingest.landing_stream(spark, land, "json", schema("sensor_events"), {"maxFilesPerTrigger": "1"})
    runner.run_append(gold.active_alerts_gold(silver.sensor_events_silver(stream), with_detected_at=False),
                      str(tmp_path / "out"), str(tmp_path / "ck"))
    streamed = spark.read.parquet(str(tmp_path / "out"))
    batch = gold.active_alerts_gold(silver.sensor_events_silver(spark.read.schema(schema("sensor_events")).json(land)),
                                    with_detected_at=False)
    assert rows(streamed) == rows(batch) and len(rows(batch)) == 12


def test_alert_detected_at_is_stamped(spark):
    df = spark.createDataFrame([("V", "T", None, "fuel_drop", 1.0, 2.0, None, True)],
                               "vehicle_id string, trip_id string, event_timestamp timestamp, anomaly_flag string, engine_temp_c double, fuel_level_litres double, cargo_temp_c double, is_critical_anomaly boolean")
    got = gold.active_alerts_gold(df).collect()[0]
    assert got["alert_detected_at"] is not None


@pytest.mark.parametrize("fmt", ["json", "csv"])
def test_landed_files_move_to_the_archive(spark, tmp_path, fmt):
    """Files leave the landing folder once taken; over restarts no row is lost or comes twice."""
    land, table, ck, archive = (str(tmp_path / x) for x in ("land", "bronze", "ck", "archive"))
    one = lambda i: json.dumps({"a": i}) + "\n" if fmt == "json" else f"a\n{i}\n"

    def run():
        ingest.ingest_source(spark, "x", land, table, ck, fmt, StructType().add("a", "integer"), options={"maxFilesPerTrigger": "2"}, rescue=True, archive=archive)
        return sorted(r.a for r in read_static(spark, table).collect())

    for i in range(5):
        _write(land, f"f{i}.{fmt}", one(i), i)
    assert run() == [0, 1, 2, 3, 4]
    assert run() == [0, 1, 2, 3, 4]
    _write(land, f"f5.{fmt}", one(5), 5)
    assert run() == [0, 1, 2, 3, 4, 5]
    _write(land, f"f6.{fmt}", one(6), 6)
    assert run() == [0, 1, 2, 3, 4, 5, 6]
    moved = [f for _, _, files in os.walk(archive) for f in files if f.endswith(fmt)]
    left = [f for f in os.listdir(land) if f.endswith(fmt)]
    assert len(moved) >= 4 and sorted(moved + left) == [f"f{i}.{fmt}" for i in range(7)]


def test_csv_columns_are_found_by_name(spark, tmp_path):
    """Added, missing, repeated and reordered columns, quoted cells, short and long lines, empty files."""
    land = str(tmp_path / "land")
    _write(land, "a.csv", 'id,amount,paid\nI1,5.5,True\n"I,2",x,False\n\nI3,1\nI4,1,True,9\n')
    _write(land, "b.csv", "\ufeffid,region,amount,paid,id\nI5,NORTH,2.5,True,again\nI6,,\"1\",,\n")
    _write(land, "c.csv", "paid,id\nTrue,I7\n")
    _write(land, "d.csv", "")
    _write(land, "e.csv", "id,paid\n")
    got = read_csv_evolving(spark, land, StructType().add("id", "string").add("amount", "double").add("paid", "boolean"))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([
        ("I1", 5.5, True, None, None), ("I,2", None, False, None, '"I,2",x,False'), ("I3", 1.0, None, None, "I3,1"), ("I4", 1.0, True, None, "I4,1,True,9"),
        ("I5", 2.5, True, '{"region":"NORTH"}', None), ("I6", 1.0, None, '{"region":null}', None), ("I7", None, True, None, None)], key=repr)


def test_bucketed_side_reads_only_matching_buckets(spark, tmp_path):
    """The plan opens the folders of the batch's buckets; a replayed micro-batch adds nothing; late rows stay unmatched."""
    land, copy, ck = (str(tmp_path / x) for x in ("land", "copy", "ck"))
    ddl = "invoice_id string, manifest_id string, amount_inr double, payment_status string"
    data = [(f"I{i}", f"M{i}" if i % 9 else None, float(i), "paid") for i in range(500)]
    spark.createDataFrame(data, ddl).write.parquet(land)
    stream = spark.readStream.schema(ddl).parquet(land)
    bucketed.fill(stream, "manifest_id", copy, ck, buckets=64)
    bucketed.fill(stream, "manifest_id", copy, ck, buckets=64)
    some = spark.createDataFrame([("M1",), ("M2",), (None,), ("M9999",)], "manifest_id string")
    match = bucketed.read_matching(spark, copy, stream.schema, some, "manifest_id", buckets=64)
    assert 2 <= match.count() < 60 and match.where("manifest_id in ('M1', 'M2')").count() == 2
    assert len({f.split("/_key_bucket=")[1].split("/")[0] for f in match.inputFiles()}) <= 3
    assert bucketed.read_matching(spark, copy, stream.schema, some.where("manifest_id is null"), "manifest_id", buckets=64).count() == 0
    assert spark.read.parquet(copy).count() == sum(m is not None for _, m, _, _ in data)
