"""Fleet-shaped views of the supplied tables.

The supplied tables (TPC-H-like plus an ``events`` stream table) stand in
for the fleet sources. Every adapter is a projection (plus, for events, a
filter on the event type), so predicate pushdown and column pruning still
reach the parquet scans. The mapping is chosen so each quality rule has rows
on both sides:

    orders    -> shipment manifests   (manifest = order)
    lineitem  -> invoices             (invoice = line; amount NULL when tax is 0)
    lineitem  -> maintenance logs     (vehicle = supplier; padded text columns)
    events    -> gps pings (views), sensor readings (clicks),
                 delivery events (all types; 'error' maps to an invalid state),
                 driver/vehicle master snapshots (daily, vehicle = user)

Trip = (user, day). Event time is rendered as an ISO-8601 UTC string, as the
devices send it, and parsed back by the silver layer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark import constants as K

ROUTE_NAMES = list(K.ROUTES)
CITY_NAMES = list(K.CITIES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _date_str(c: str) -> Column:
    return F.col(c).cast("date").cast("string")


def _pick(names: list[str], idx: Column) -> Column:
    """names[idx] as a CASE expression (idx in 0..len-1)."""
    expr = None
    for i, n in enumerate(names):
        expr = F.when(idx == i, F.lit(n)) if expr is None else expr.when(idx == i, F.lit(n))
    return expr


def iso_utc(c: str) -> Column:
    """TIMESTAMP_NTZ -> 'yyyy-MM-ddTHH:mm:ss.SSSSSS+00:00'."""
    return F.concat(F.date_format(F.col(c), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def trip_id(user: str = "user_id", ts: str = "ts") -> Column:
    return F.concat(F.col(user).cast("string"), F.lit("-"), _date_str(ts))


def route_of(user: str = "user_id") -> Column:
    return _pick(ROUTE_NAMES, F.pmod(F.col(user), F.lit(len(ROUTE_NAMES))))


# --- batch sources ---------------------------------------------------------------
def manifests(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("manifest_id"),
        _date_str("o_orderdate").alias("shipment_date"),
        F.col("o_custkey").alias("vehicle_id"),
        F.col("o_orderstatus").alias("route_name"),
        F.col("o_custkey").cast("string").alias("customer_name"),
        F.col("o_orderstatus").alias("destination_city"),
        (F.col("o_totalprice") / 10000).cast("int").alias("package_count"),
        ((F.col("o_totalprice") - 20000) / 100).alias("total_weight_kg"),
        (F.col("o_orderstatus") == "F").alias("is_cold_chain"),
        F.col("o_orderpriority").alias("priority"),
    )


def invoices(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("invoice_id"),
        F.col("l_orderkey").alias("manifest_id"),
        _date_str("l_shipdate").alias("invoice_date"),
        F.col("l_suppkey").cast("string").alias("customer_name"),
        F.when(F.col("l_tax") != 0, F.col("l_extendedprice")).alias("amount_inr"),
        F.col("l_linestatus").alias("payment_status"),
    )


def maintenance_logs(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("log_id"),
        _date_str("l_shipdate").alias("service_date"),
        F.col("l_suppkey").alias("vehicle_id"),
        F.concat(F.lit("  "), F.col("l_returnflag"), F.lit(" ")).alias("issue_type"),
        F.when(F.col("l_discount") != 0, F.col("l_extendedprice")).otherwise(F.lit(0.0)).alias("cost_inr"),
        ((F.col("l_quantity").cast("int") - 1) * 1000).alias("odometer_km"),
        F.concat(F.lit(" "), F.col("l_linestatus"), F.lit("  ")).alias("service_center"),
    )


def master_snapshots(events: DataFrame) -> DataFrame:
    """Daily snapshots per vehicle; several events of a user on one day give
    conflicting snapshots of one (vehicle, date), resolved by the SCD rules."""
    return events.select(
        _date_str("ts").alias("snapshot_date"),
        F.col("user_id").alias("vehicle_id"),
        F.concat(F.lit("MH-"), F.col("user_id").cast("string")).alias("license_plate"),
        F.col("event_type").alias("vehicle_type"),
        F.concat(F.lit("D"), F.floor(F.col("value") / 50).cast("string")).alias("driver_id"),
        F.concat(F.lit("driver-"), F.floor(F.col("value") / 50).cast("string")).alias("driver_name"),
        F.concat(F.lit("9"), F.lpad(F.col("user_id").cast("string"), 9, "0")).alias("driver_phone"),
        F.concat(F.lit("DL-"), F.col("user_id").cast("string")).alias("driver_license_no"),
        route_of().alias("home_route"),
        (F.col("value") >= 1).alias("is_active"),
        F.col("props").alias("last_change_type"),
    )


# --- event sources ----------------------------------------------------------------
def gps_events(events: DataFrame) -> DataFrame:
    v = F.col("value")
    return events.where(F.col("event_type") == "view").select(
        F.lit("gps").alias("event_type"),
        trip_id().alias("trip_id"),
        F.col("user_id").alias("vehicle_id"),
        F.concat(F.lit("D"), F.col("user_id").cast("string")).alias("driver_id"),
        iso_utc("ts").alias("timestamp"),
        (F.lit(7.5) + v / 8).alias("lat"),
        (F.lit(68.0) + v / 4).alias("lon"),
        v.alias("speed_kmph"),
        F.col("props").alias("heading"),
        v.alias("distance_traveled_km"),
        route_of().alias("route_name"),
    )


def sensor_events(events: DataFrame) -> DataFrame:
    v = F.col("value")
    return events.where(F.col("event_type") == "click").select(
        F.lit("sensor").alias("event_type"),
        trip_id().alias("trip_id"),
        F.col("user_id").alias("vehicle_id"),
        iso_utc("ts").alias("timestamp"),
        (v - 20).alias("engine_temp_c"),
        v.alias("fuel_level_litres"),
        F.when(F.pmod(F.col("user_id"), F.lit(2)) == 1, v / 2 - 30).alias("cargo_temp_c"),
        F.when(v > 120, F.lit("engine_overheat")).when(v < 2, F.lit("fuel_drop")).alias("anomaly_flag"),
    )


STATUS_OF_EVENT = {
    "signup": "created",
    "click": "picked_up",
    "view": "in_transit",
    "purchase": "delivered",
}


def delivery_events(events: DataFrame) -> DataFrame:
    status = None
    for ev, st in STATUS_OF_EVENT.items():
        status = F.when(F.col("event_type") == ev, F.lit(st)) if status is None else status.when(F.col("event_type") == ev, F.lit(st))
    status = status.otherwise(F.lit("exception"))
    return events.select(
        F.lit("delivery").alias("event_type"),
        trip_id().alias("trip_id"),
        F.col("user_id").alias("vehicle_id"),
        iso_utc("ts").alias("timestamp"),
        status.alias("status"),
        _pick(CITY_NAMES, F.pmod(F.col("user_id"), F.lit(len(CITY_NAMES)))).alias("location_city"),
    )
