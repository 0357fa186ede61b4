from pyspark.sql import functions as F

from fleetspark.functions.geo import haversine_km
from fleetspark.operators import routes


def test_haversine_identical_points(spark):
    df = spark.createDataFrame([(19.0, 72.8)], "a double, b double")
    assert df.select(haversine_km(F.col("a"), F.col("b"), F.col("a"), F.col("b")).alias("d")).collect()[0]["d"] == 0.0


def test_waypoints_and_totals(spark):
    wp = routes.route_waypoints(spark).where(F.col("route_name") == "ROUTE_MUM_NASHIK_AURANGABAD").orderBy("seq").collect()
    assert [(r["city"], r["cumulative_km"], r["speed_limit_kmph"]) for r in wp] == [
        ("Mumbai", 0.0, 80), ("Nashik", 150.0, 80), ("Aurangabad", 330.0, 70)
    ]
    tot = {r["route_name"]: r["total_km"] for r in routes.route_totals(spark).collect()}
    assert tot["ROUTE_MUM_NASHIK_AURANGABAD"] == 330.0 and tot["ROUTE_MUM_PUNE"] == 94.5


def test_position_on_route(spark):
    df = spark.createDataFrame(
        [(i, "ROUTE_MUM_NASHIK_AURANGABAD", d) for i, d in enumerate([-5.0, 0.0, 150.0, 400.0, 75.0])]
        + [(9, "NOPE", 1.0)],
        "id int, route string, km double",
    )
    got = {r["id"]: r for r in routes.position_on_route(df, "route", "km").collect()}
    assert got[0]["distance_km"] == 0.0 and got[1]["pos_lat"] == 19.076
    assert got[2]["nearest_segment_end_city"] == "Nashik" and got[2]["speed_limit_kmph"] == 80
    assert got[2]["pos_lat"] == 19.9975
    assert got[3]["distance_km"] == 330.0 and got[3]["nearest_segment_end_city"] == "Aurangabad"
    assert got[4]["pos_lat"] == round(19.076 + (19.9975 - 19.076) * 0.5, 6)
    assert got[9]["pos_lat"] is None


def test_eta(spark):
    eta = {r["route_name"]: r["expected_hours"] for r in routes.route_eta(spark).collect()}
    assert eta["ROUTE_MUM_NASHIK_AURANGABAD"] == 5.87


def test_trip_distance(spark):
    df = spark.createDataFrame(
        [("t", 1, 19.0, 73.0), ("t", 2, 19.0, 73.0), ("t", 3, 19.1, 73.0), ("u", 1, 18.0, 72.0)],
        "trip string, ts int, lat double, lon double",
    )
    got = {r["trip"]: (r["pings"], round(r["total_km"], 3)) for r in routes.trip_distance(df, ["trip"], "ts").collect()}
    assert got["u"] == (1, 0.0)
    assert got["t"][0] == 3 and abs(got["t"][1] - 11.119) < 0.01
