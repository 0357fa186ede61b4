from pyspark.sql import functions as F

from fleetspark.operators.expectations import ExpectationSet, expect, expect_or_drop
from fleetspark.plans import silver
from tests.conftest import rows


def test_inclusive_bounds_and_null_fails(spark):
    df = spark.createDataFrame(
        [(1, 8.0), (2, 37.0), (3, 7.999), (4, 37.001), (5, None)], "id int, lat double"
    )
    rules = ExpectationSet([expect_or_drop("valid_latitude", "lat BETWEEN 8.0 AND 37.0")])
    assert rows(rules.apply(df), "id") == [(1,), (2,)]


def test_speed_and_cargo_rules(spark):
    gps = spark.createDataFrame(
        [(1, 0.0), (2, 150.0), (3, -0.1), (4, 150.1)], "id int, speed_kmph double"
    )
    r = ExpectationSet([silver.GPS_RULES.rules[2]])
    assert rows(r.apply(gps), "id") == [(1,), (2,)]
    sensor = spark.createDataFrame(
        [(1, None), (2, -30.0), (3, 50.0), (4, 50.1)], "id int, cargo_temp_c double"
    )
    r = ExpectationSet([silver.SENSOR_RULES.rules[2]])
    assert rows(r.apply(sensor), "id") == [(1,), (2,), (3,)]


def test_warn_rule_keeps_row_and_counts(spark):
    df = spark.createDataFrame([(1, "t1"), (2, None)], "id int, trip_id string")
    rules = ExpectationSet([expect("has_trip_id", "trip_id IS NOT NULL")])
    assert rows(rules.apply(df), "id") == [(1,), (2,)]
    rep = rules.report(df).collect()[0]
    assert (rep["rule"], rep["action"], rep["passed_rows"], rep["failed_rows"]) == ("has_trip_id", "warn", 1, 1)


def test_strictly_positive_rules(spark):
    df = spark.createDataFrame(
        [(1, 10.0, 5), (2, 0.0, 5), (3, 10.0, 0), (4, None, 3)], "id int, cost_inr double, odometer_km int"
    )
    df = df.withColumn("issue_type", F.lit(" x ")).withColumn("service_center", F.lit(" c"))
    assert rows(silver.maintenance_logs_silver(df), "id", "issue_type", "service_center") == [(1, "x", "c")]


def test_delivery_status_rule(spark):
    df = spark.createDataFrame([(1, "delivered"), (2, "exception"), (3, None), (4, "Delivered")], "id int, status string")
    assert rows(silver.DELIVERY_RULES.apply(df), "id") == [(1,)]


def test_quarantine_lists_every_failed_rule(spark):
    df = spark.createDataFrame(
        [(1, 10.0, 2, 5.0), (2, -1.0, 0, None), (3, -1.0, 4, 1.0)],
        "id int, total_weight_kg double, package_count int, amount_inr double",
    )
    q = silver.SHIPMENT_INVOICE_RULES.quarantine(df)
    got = {r["id"]: list(r["_failed_rules"]) for r in q.collect()}
    assert got == {2: ["valid_weight", "valid_package_count", "valid_amount"], 3: ["valid_weight"]}
    kept = silver.SHIPMENT_INVOICE_RULES.apply(df)
    assert rows(kept, "id") == [(1,)]


def test_not_p_would_lose_nulls(spark):
    # The fail side must be NOT coalesce(p, false): 3 rows -> 1 pass, 2 fail.
    df = spark.createDataFrame([(1, 5.0), (2, -5.0), (3, None)], "id int, v double")
    rules = ExpectationSet([expect_or_drop("pos", "v > 0")])
    rep = rules.report(df).collect()[0]
    assert (rep["passed_rows"], rep["failed_rows"]) == (1, 2)
