"""Silver datasets (M8-M13): pure DataFrame -> DataFrame builders.

Each works on static and streaming input. Rule sets are module constants so
reports and quarantines use the same rules as the builders. Expectations run
on the builder's *result* (after dedup), as in the source pipeline: an invalid
row can displace a valid twin in the dedup.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetspark import constants as K
from fleetspark.functions import scalar as S
from fleetspark.operators import joins, scd
from fleetspark.operators.expectations import ExpectationSet, expect, expect_or_drop
from fleetspark.streaming.dedup import dedup_within_watermark

# --- rule sets -------------------------------------------------------------
def _within(column: str, bounds: tuple[float, float]) -> str:
    """Predicate for an inclusive range."""
    low, high = bounds
    return f"{column} BETWEEN {low} AND {high}"


def _one_of(column: str, values) -> str:
    return f"{column} IN ({', '.join(map(repr, values))})"


# FIXED VALUES: the rule names surface in reports and quarantine tables.
GPS_RULES = ExpectationSet([
    expect_or_drop("valid_latitude", _within("lat", K.LAT_RANGE)),
    expect_or_drop("valid_longitude", _within("lon", K.LON_RANGE)),
    expect_or_drop("valid_speed", _within("speed_kmph", K.SPEED_RANGE)),
    expect("has_trip_id", "trip_id IS NOT NULL"),
])

SENSOR_RULES = ExpectationSet([
    expect_or_drop("valid_engine_temp", _within("engine_temp_c", K.ENGINE_TEMP_RANGE)),
    expect_or_drop("valid_fuel_level", _within("fuel_level_litres", K.FUEL_RANGE)),
    expect_or_drop("valid_cargo_temp", f"cargo_temp_c IS NULL OR {_within('cargo_temp_c', K.CARGO_TEMP_RANGE)}"),
])

DELIVERY_RULES = ExpectationSet([
    expect_or_drop("valid_status", _one_of("status", K.DELIVERY_STATE_ORDER)),
])

MAINTENANCE_RULES = ExpectationSet([
    expect_or_drop("valid_cost", "cost_inr > 0"),
    expect_or_drop("valid_odometer_km", "odometer_km > 0"),
])

SHIPMENT_INVOICE_RULES = ExpectationSet([
    expect_or_drop("valid_weight", "total_weight_kg > 0"),
    expect_or_drop("valid_package_count", "package_count > 0"),
    expect("valid_amount", "amount_inr IS NOT NULL"),
])

# FIXED VALUES: columns of the joined table, as its readers know them.
MANIFEST_COLS = [
    "manifest_id", "shipment_date", "vehicle_id", "route_name", "customer_name",
    "destination_city", "package_count", "total_weight_kg", "is_cold_chain", "priority",
]
INVOICE_COLS = ["invoice_id", "amount_inr", "payment_status"]


EVENT_KEY = ["trip_id", "event_timestamp"]


# Ahead of the dedup: there, rows without a time would all be twins of each other.
EVENT_TIME_RULES = ExpectationSet([expect_or_drop("valid_event_time", "event_timestamp IS NOT NULL")])


# Lines of a CSV file that don't fit its header: which of their cells belong to which column is unknown.
LINE_RULES = ExpectationSet([expect_or_drop("fits_header", "_corrupt_record IS NULL")])


def with_event_time(bronze: DataFrame) -> DataFrame:
    return bronze.withColumn("event_timestamp", S.parse_event_time("timestamp"))


def _event_prepared(bronze: DataFrame, watermark: str | None, **derived: Column) -> DataFrame:
    """An event source before its rules: parsed event time, derived columns, watermark, one row per trip and time.
    Rows whose time can't be parsed are left to ``EVENT_TIME_RULES.quarantine(with_event_time(...))``."""
    events = EVENT_TIME_RULES.apply(with_event_time(bronze)).withColumns(derived)
    if watermark:
        events = events.withWatermark("event_timestamp", watermark)
    return dedup_within_watermark(events, EVENT_KEY)


# --- M8 ---------------------------------------------------------------------
def gps_events_prepared(bronze_gps: DataFrame, watermark: str | None = K.GPS_WATERMARK) -> DataFrame:
    return _event_prepared(bronze_gps, watermark)


def gps_events_silver(bronze_gps: DataFrame, watermark: str | None = K.GPS_WATERMARK) -> DataFrame:
    """Rows without an event time are left out (``EVENT_TIME_RULES`` has them), as in the other event sources."""
    return GPS_RULES.apply(gps_events_prepared(bronze_gps, watermark))


# --- M9 ---------------------------------------------------------------------
def sensor_events_prepared(bronze_sensor: DataFrame, watermark: str | None = K.SENSOR_WATERMARK) -> DataFrame:
    return _event_prepared(bronze_sensor, watermark, is_critical_anomaly=F.col("anomaly_flag").isNotNull())


def sensor_events_silver(bronze_sensor: DataFrame, watermark: str | None = K.SENSOR_WATERMARK) -> DataFrame:
    return SENSOR_RULES.apply(sensor_events_prepared(bronze_sensor, watermark))


# --- M10 --------------------------------------------------------------------
def delivery_events_prepared(bronze_delivery: DataFrame, watermark: str | None = K.DELIVERY_WATERMARK) -> DataFrame:
    return _event_prepared(bronze_delivery, watermark, status_order=S.status_order("status"))


def delivery_events_silver(bronze_delivery: DataFrame, watermark: str | None = K.DELIVERY_WATERMARK) -> DataFrame:
    return DELIVERY_RULES.apply(delivery_events_prepared(bronze_delivery, watermark))


# --- M11 --------------------------------------------------------------------
def shipment_invoice_prepared(manifests: DataFrame, invoices: DataFrame) -> DataFrame:
    """C1 + B8 + B2: manifests left-joined to invoices (fan-out), ``is_invoiced``."""
    joined = joins.left_join_keep_all(
        manifests, invoices, "manifest_id", "manifest_id", MANIFEST_COLS, INVOICE_COLS
    )
    return joined.withColumn("is_invoiced", F.col("invoice_id").isNotNull())


def shipment_invoice_silver(manifests: DataFrame, invoices: DataFrame) -> DataFrame:
    # The drop rules only read manifest columns, so Catalyst pushes them below
    # the join (and into the manifest scan).
    return SHIPMENT_INVOICE_RULES.apply(shipment_invoice_prepared(manifests, invoices))


# --- M12 --------------------------------------------------------------------
def maintenance_logs_prepared(bronze_maintenance: DataFrame) -> DataFrame:
    return bronze_maintenance.withColumns({c: S.trimmed(c) for c in ("issue_type", "service_center")})


def maintenance_logs_silver(bronze_maintenance: DataFrame) -> DataFrame:
    return MAINTENANCE_RULES.apply(maintenance_logs_prepared(bronze_maintenance))


# --- M13 --------------------------------------------------------------------
MASTER_KEYS = ["vehicle_id"]
MASTER_SEQUENCE = "snapshot_date"
MASTER_UNTRACKED = ["snapshot_date", "last_change_type", "_ingested_at", "_source_file", "_source_name"]


def driver_vehicle_master_silver(bronze_master: DataFrame, track_all: bool = True) -> DataFrame:
    """K1 over master snapshots. ``track_all=True`` is the source pipeline's
    behaviour (every column, so every snapshot opens a version);
    ``track_all=False`` is the intended history (K3): one version per real
    change, ignoring the sequence, metadata and ``last_change_type``."""
    if track_all:
        return scd.scd2(bronze_master, MASTER_KEYS, MASTER_SEQUENCE)
    return scd.scd2(bronze_master, MASTER_KEYS, MASTER_SEQUENCE, track_except=MASTER_UNTRACKED)


def driver_vehicle_master_current(bronze_master: DataFrame) -> DataFrame:
    """The open versions where every column is tracked: the latest snapshot of each vehicle, in one aggregate
    instead of a whole history."""
    return scd.scd1(bronze_master, MASTER_KEYS, MASTER_SEQUENCE)
