import datetime as dt
import json
import os

from pyspark.sql import functions as F

import pytest

from fleetspark.operators import governance, topk
from fleetspark.plans import registry, silver
from fleetspark.schemas import schema
from fleetspark.sources import ingest
from fleetspark.sources.evolution import read_json_evolving
from fleetspark.streaming import runner
from tests.conftest import rows


def test_masking(spark):
    df = spark.createDataFrame([("9876543210", "MH1234"), (None, "X")], "driver_phone string, driver_license_no string")
    h = governance.mask_for_environment(df, "uat", key="k").collect()
    assert len(h[0]["driver_phone"]) == 64 and h[1]["driver_phone"] is None
    with pytest.raises(ValueError):
        governance.mask_for_environment(df, "uat")
    assert h[0]["driver_phone"] != governance.mask_for_environment(df, "uat", key="other").collect()[0]["driver_phone"]
    r = governance.mask_for_environment(df, "prod").collect()
    assert r[0]["driver_phone"] == "********10" and r[0]["driver_license_no"] == "****34" and r[1]["driver_license_no"] == "*"
    assert governance.mask_for_environment(df, "dev").collect() == df.collect()


def test_row_security_semi_join(spark):
    df = spark.createDataFrame([(1, "A"), (2, "B"), (3, None)], "id int, route string")
    grants = spark.createDataFrame([("p", "A"), ("p", "A"), ("q", "B")], "principal string, route string")
    assert rows(governance.restrict_rows(df, grants, "p", "route"), "id") == [(1,)]


def test_schema_evolution_rescues_unknown_fields(spark, tmp_path):
    p = tmp_path / "j"
    p.mkdir()
    (p / "a.json").write_text(json.dumps({"a": 1, "b": "x", "new_field": 3.5}) + "\n" + json.dumps({"a": 2}) + "\n")
    got = read_json_evolving(spark, str(p), schema_from("a int, b string")).orderBy("a").collect()
    assert got[0]["_rescued_data"] == {"new_field": "3.5"} and got[1]["_rescued_data"] == {}


def schema_from(ddl):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl)


def test_registry_order_and_build(spark):
    order = registry.order()
    assert order.index("shipment_invoice_silver") < order.index("daily_revenue_gold")
    assert order.index("driver_vehicle_master_silver") < order.index("vehicle_scorecard_gold")
    man = spark.createDataFrame([("M1", "2026-05-01", "V", "R", "c", "x", 1, 1.0, False, "standard")], schema("shipment_manifests"))
    inv = spark.createDataFrame([("I1", "M1", "2026-05-01", "c", 5.0, "paid")], schema("invoices"))
    built = registry.build({"shipment_manifests": man, "invoices": inv})
    assert set(built) == {"shipment_invoice_silver", "daily_revenue_gold"}
    assert built["daily_revenue_gold"].collect()[0]["revenue"] == 5.0


def test_latest_topk(spark):
    df = spark.createDataFrame([(i, dt.datetime(2026, 5, 1, 10, i % 7)) for i in range(30)], "id int, ts timestamp")
    got = [r["id"] for r in topk.latest(df, "ts", 3, ["id"]).collect()]
    assert got == [27, 20, 13]


def test_stream_expectation_metrics(spark, tmp_path):
    land = tmp_path / "gps"
    land.mkdir()
    recs = [
        {"trip_id": "A", "timestamp": "2026-05-01T10:00:00+00:00", "lat": 19.0, "lon": 73.0, "speed_kmph": 10.0},
        {"trip_id": None, "timestamp": "2026-05-01T10:00:01+00:00", "lat": 50.0, "lon": 73.0, "speed_kmph": 10.0},
    ]
    (land / "a.json").write_text("\n".join(json.dumps(r) for r in recs) + "\n")
    stream = ingest.landing_stream(spark, str(land), "json", schema("gps_events"))
    prepared = silver.gps_events_prepared(stream)
    observed = silver.GPS_RULES.observe(prepared, "gps_rules")
    q = runner.run_append(silver.GPS_RULES.apply(observed), str(tmp_path / "out"), str(tmp_path / "ck"))
    metrics = [p["observedMetrics"]["gps_rules"] for p in q.recentProgress if p.get("observedMetrics")]
    assert metrics and metrics[0]["total_rows"] == 2
    assert metrics[0]["failed__valid_latitude"] == 1 and metrics[0]["failed__has_trip_id"] == 1
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_row_security_from_configuration(spark):
    df = spark.createDataFrame([(1, "A"), (2, "B"), (3, None)], "id int, route string")
    grants = [("p", "A"), ("p", "A"), ("q", "B")]
    assert rows(governance.restrict_rows_to(df, grants, "p", "route"), "id") == [(1,)]
    assert rows(governance.restrict_rows_to(df, grants, "nobody", "route"), "id") == []


def test_ingest_keeps_unknown_fields_and_broken_records(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    lines = [{"a": 1, "b": "x"}, {"a": 2, "new": {"q": [1, 2]}}, {"a": "no number", "t": "2026-05-01T10:00:00Z", "f": True}]
    (land / "a.json").write_text("\n".join(map(json.dumps, lines)) + "\n\n{\"a\": 3, \n")
    ddl = schema_from("a int, b string, t timestamp, f boolean, l array<int>")
    q = ingest.ingest_source(spark, "x", str(land), str(tmp_path / "out"), str(tmp_path / "ck"), "json", ddl, rescue=True)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.columns == ["a", "b", "t", "f", "l", "_rescued_data", "_corrupt_record", "_ingested_at", "_source_file", "_source_name"]
    found = [(r["a"], r["b"], r["f"], r["_rescued_data"], r["_corrupt_record"]) for r in got.collect()]
    assert sorted(found, key=repr) == sorted([
        (1, "x", None, None, None), (2, None, None, json.dumps({"new": json.dumps({"q": [1, 2]}, separators=(",", ":"))}, separators=(",", ":")), None),
        (None, None, True, None, None), (None, None, None, None, '{"a": 3, ')], key=repr)
    assert got.where("_source_file is null").isEmpty() and q.exception() is None


def test_csv_ingest_keeps_broken_records(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    (land / "a.csv").write_text("a,b\n1,x\nfive,y\n")
    ingest.ingest_source(spark, "x", str(land), str(tmp_path / "out"), str(tmp_path / "ck"), "csv", schema_from("a int, b string"), rescue=True)
    assert rows(spark.read.parquet(str(tmp_path / "out")), "a", "b", "_corrupt_record", "_rescued_data") == [
        (1, "x", None, None), (None, "y", "five,y", None)]


def test_rows_without_a_time_are_kept_aside_not_merged(spark):
    bronze = spark.createDataFrame([("T", "soon", 1.0), ("T", "later", 2.0), ("T", None, 3.0), ("T", "2026-05-01T10:00:00Z", 4.0)],
                                   "trip_id string, timestamp string, lat double")
    assert rows(silver.gps_events_prepared(bronze), "lat") == [(4.0,)]
    aside = silver.EVENT_TIME_RULES.quarantine(silver.with_event_time(bronze))
    assert rows(aside, "lat", "_failed_rules") == [(x, ["valid_event_time"]) for x in (1.0, 2.0, 3.0)]
