import json
import os

from fleetspark.operators.ledger import CLASSES
from fleetspark.streaming import runner
from fleetspark.plans import jobs
from fleetspark.sources.tables import TableNames
from tests.conftest import rows


def _lines(path, name, recs):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(json.dumps(r) for r in recs) + "\n")


def _csv(path, name, header, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write(header + "\n" + "\n".join(lines) + "\n")


def test_batch_job_end_to_end(spark, tmp_path):
    land = str(tmp_path / "landing")
    _lines(f"{land}/shipment_manifests", "d1.json", [
        {"manifest_id": m, "shipment_date": "2026-05-01", "vehicle_id": v, "route_name": "ROUTE_MUM_PUNE",
         "customer_name": "Acme", "destination_city": "Pune", "package_count": p, "total_weight_kg": 100.0,
         "is_cold_chain": False, "priority": "standard"}
        for m, v, p in [("M1", "TRK001", 2), ("M2", "TRK002", 0), ("M3", "TRK001", 1)]])
    _csv(f"{land}/invoices", "d1.csv", "invoice_id,manifest_id,invoice_date,customer_name,amount_inr,payment_status",
         ["I1,M1,2026-05-01,Acme,100.0,paid", "I3,M3,2026-05-01,Acme,50.5,pending"])
    _csv(f"{land}/maintenance_logs", "d1.csv", "log_id,service_date,vehicle_id,issue_type,cost_inr,odometer_km,service_center",
         ["L1,2026-05-01,TRK001,brake,10.0,100,C", "L2,2026-05-02,TRK001,tyre,5.0,110,C", "L3,2026-05-02,TRK003,oil,1.0,10,C", "L4,2026-05-02"])
    hdr = "snapshot_date,vehicle_id,license_plate,vehicle_type,driver_id,driver_name,driver_phone,driver_license_no,home_route,is_active,last_change_type"
    _csv(f"{land}/driver_vehicle_master", "d1.csv", hdr, [
        "2026-05-01,TRK001,MH01,medium_truck,D1,Asha,1,L1,ROUTE_MUM_PUNE,True,",
        "2026-05-02,TRK001,MH01,medium_truck,D2,Ravi,2,L2,ROUTE_MUM_PUNE,True,driver_change",
    ])
    out = jobs.run_batch_job(spark, land, str(tmp_path / "lake"), str(tmp_path / "ck"))
    assert rows(runner.read_upserts(spark, out["gold.daily_revenue_gold"])) == [("2026-05-01", "ROUTE_MUM_PUNE", "standard", 150.5)]
    card = rows(runner.read_complete(spark, out["gold.vehicle_scorecard_gold"]), "vehicle_id", "driver_name", "total_maintenance_cost_inr", "maintenance_event_count")
    assert card == [("TRK001", "Ravi", 15.0, 2), ("TRK003", None, 1.0, 1)]
    # what the rules refuse is kept, and counted
    assert rows(spark.read.parquet(out["quarantine.shipment_invoice_silver"]), "manifest_id", "_failed_rules") == [("M2", ["valid_package_count", "valid_amount"])]
    counts = {r["rule"]: (r["passed_rows"], r["failed_rows"]) for r in jobs.rule_counts(spark, out["rules.shipment_invoice_silver"]).collect()}
    assert rows(spark.read.parquet(out["quarantine.maintenance_logs_silver_unread"]), "_corrupt_record", "_failed_rules") == [("L4,2026-05-02", ["fits_header"])]
    logs = {r["rule"]: (r["passed_rows"], r["failed_rows"]) for r in jobs.rule_counts(spark, out["rules.maintenance_logs_silver"]).collect()}
    assert logs == {"fits_header": (3, 1), "valid_cost": (3, 0), "valid_odometer_km": (3, 0)}
    assert counts == {"valid_weight": (3, 0), "valid_package_count": (2, 1), "valid_amount": (2, 1)}
    # every table is known by its name
    names = TableNames.from_session(spark, str(tmp_path / "lake"))
    by_name = lambda layer, t: spark.table(names.spark_name(spark, layer, t))
    assert names.spark_name(spark, "gold", "t") == "spark_catalog.`lake_gold`.`t`"
    assert rows(by_name("gold", "daily_revenue_gold")) == [("2026-05-01", "ROUTE_MUM_PUNE", "standard", 150.5)]
    assert by_name("silver", "driver_vehicle_master_silver").count() == 2 and by_name("bronze", "invoices").count() == 2
    assert rows(by_name("quarantine", "shipment_invoice_silver"), "manifest_id") == [("M2",)]
    # re-running on the same checkpoints adds nothing
    jobs.run_batch_job(spark, land, str(tmp_path / "lake"), str(tmp_path / "ck"))
    assert spark.read.parquet(out["silver.shipment_invoice_silver"]).count() == 2


def test_stream_job_end_to_end(spark, tmp_path):
    land = str(tmp_path / "landing")
    ts = lambda m, s=0: f"2026-05-01T10:{m:02d}:{s:02d}+00:00"
    _lines(f"{land}/gps_events", "t1.json", [
        {"event_type": "gps", "trip_id": "T1", "vehicle_id": "V1", "driver_id": "D1", "timestamp": ts(m), "lat": 19.0,
         "lon": 73.0, "speed_kmph": 50.0, "heading": "N", "distance_traveled_km": float(m), "route_name": "R"}
        for m in range(0, 30, 5)] + [
        {"event_type": "gps", "trip_id": "T1", "vehicle_id": "V1", "driver_id": "D1", "timestamp": ts(0), "lat": 19.0,
         "lon": 73.0, "speed_kmph": 50.0, "heading": "N", "distance_traveled_km": 0.0, "route_name": "R"}])
    _lines(f"{land}/sensor_events", "t1.json", [
        {"event_type": "sensor", "trip_id": "T1", "vehicle_id": "V1", "timestamp": ts(m, 10), "engine_temp_c": 90.0,
         "fuel_level_litres": 100.0 - m, "cargo_temp_c": None, "anomaly_flag": "fuel_drop" if m == 20 else None}
        for m in range(0, 30, 5)])
    _lines(f"{land}/delivery_events", "t1.json", [
        {"event_type": "delivery", "trip_id": "T1", "vehicle_id": "V1", "timestamp": ts(1), "status": "picked_up", "location_city": "Pune"},
        {"event_type": "delivery", "trip_id": "T1", "vehicle_id": "V1", "timestamp": "2026-05-01T13:00:00+00:00", "status": "delivered", "location_city": "Pune"}])
    out = jobs.run_stream_job(spark, land, str(tmp_path / "lake"), str(tmp_path / "ck"))
    assert spark.read.parquet(out["silver.gps_events_silver"]).count() == 6          # duplicate ping removed
    assert rows(spark.read.parquet(out["gold.active_alerts_gold"]), "anomaly_flag") == [("fuel_drop",)]
    perf = rows(spark.read.parquet(out["gold.delivery_performance_gold"]), "status", "event_count")
    assert perf == [("picked_up", 1)]                                                  # 13:00 window still open
    fuel = runner.read_upserts(spark, out["gold.fuel_cost_efficiency_gold"]).collect()
    assert len(fuel) == 1 and fuel[0]["estimated_fuel_consumed_litres"] == 25.0 and fuel[0]["estimated_distance_km"] == 25.0
    live = spark.read.parquet(out["gold.live_fleet_status_gold"]).count()
    assert live == 6                                                                   # each ping meets the reading 10 s later


def test_backlog_in_many_micro_batches_with_late_and_untimed_rows(spark, tmp_path):
    """Five files, one a micro-batch: the counts cover all of them, a ping later than the watermark is left out, a
    repeated one too, and rows without a time are kept aside."""
    land = str(tmp_path / "landing")
    ping = lambda stamp, lat=19.0: {
        "event_type": "gps", "trip_id": "T1", "vehicle_id": "V1", "driver_id": "D1", "timestamp": stamp, "lat": lat, "lon": 73.0,
        "speed_kmph": 50.0, "heading": "N", "distance_traveled_km": 1.0, "route_name": "R"}
    at = lambda h, m: f"2026-05-01T{h:02d}:{m:02d}:00+00:00"
    files = [[ping(at(10, 0)), ping(at(10, 1), 90.0)], [ping(at(10, 1)), ping("never")], [ping(at(12, 0))],
             [ping(at(12, 1)), ping("never"), ping(at(12, 0))], [ping(at(10, 30)), ping(at(12, 2))]]
    for i, recs in enumerate(files):
        name = f"f{i}.json"
        _lines(f"{land}/gps_events", name, recs)
        os.utime(f"{land}/gps_events/{name}", (1_700_000_000 + i, 1_700_000_000 + i))
    for source, rec in [("sensor_events", {"event_type": "sensor", "trip_id": "T1", "vehicle_id": "V1", "timestamp": at(10, 0),
                                           "engine_temp_c": 90.0, "fuel_level_litres": 1.0}),
                        ("delivery_events", {"event_type": "delivery", "trip_id": "T1", "vehicle_id": "V1", "timestamp": at(10, 0),
                                             "status": "picked_up", "location_city": "Pune"})]:
        _lines(f"{land}/{source}", "f.json", [rec])
    out = jobs.run_stream_job(spark, land, str(tmp_path / "lake"), str(tmp_path / "ck"), max_files=1)
    times = [t.strftime("%H:%M") for (t,) in rows(spark.read.parquet(out["silver.gps_events_silver"]), "event_timestamp")]
    # the invalid twin of 10:01 came first, so the dedup kept that one; 10:30 came when the watermark was past it
    assert times == ["10:00", "12:00", "12:01", "12:02"]
    assert spark.read.parquet(out["quarantine.gps_events_silver_untimed"]).count() == 2
    counts = {r["rule"]: (r["passed_rows"], r["failed_rows"]) for r in jobs.rule_counts(spark, out["rules.gps_events_silver"]).collect()}
    assert counts["valid_latitude"] == (4, 1) and counts["has_trip_id"] == (5, 0) and counts["valid_event_time"] == (5, 2)
    ledger = {r.dataset: r for r in jobs.event_ledger(spark, out).collect()}
    assert [ledger["gps_events_silver"][c] for c in CLASSES] == [10, 4, 1, 2, 2, 1, 0, 0]
