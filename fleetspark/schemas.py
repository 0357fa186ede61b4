"""Source schemas: fixed and explicit, every column nullable.

FIXED VALUES: column names, order and types of the seven landing sources.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

# DDL strings keep the schemas readable; ``schema(name)`` parses them.
SOURCE_DDL = {
    "shipment_manifests": (
        "manifest_id string, shipment_date string, vehicle_id string, route_name string, "
        "customer_name string, destination_city string, package_count int, "
        "total_weight_kg double, is_cold_chain boolean, priority string"
    ),
    "invoices": (
        "invoice_id string, manifest_id string, invoice_date string, customer_name string, "
        "amount_inr double, payment_status string"
    ),
    "maintenance_logs": (
        "log_id string, service_date string, vehicle_id string, issue_type string, "
        "cost_inr double, odometer_km int, service_center string"
    ),
    "driver_vehicle_master": (
        "snapshot_date string, vehicle_id string, license_plate string, vehicle_type string, "
        "driver_id string, driver_name string, driver_phone string, driver_license_no string, "
        "home_route string, is_active boolean, last_change_type string"
    ),
    "gps_events": (
        "event_type string, trip_id string, vehicle_id string, driver_id string, timestamp string, "
        "lat double, lon double, speed_kmph double, heading string, distance_traveled_km double, "
        "route_name string"
    ),
    "sensor_events": (
        "event_type string, trip_id string, vehicle_id string, timestamp string, "
        "engine_temp_c double, fuel_level_litres double, cargo_temp_c double, anomaly_flag string"
    ),
    "delivery_events": (
        "event_type string, trip_id string, vehicle_id string, timestamp string, "
        "status string, location_city string"
    ),
}

# source -> landing file format
SOURCE_FORMAT = {
    "shipment_manifests": "json",
    "invoices": "csv",
    "maintenance_logs": "csv",
    "driver_vehicle_master": "csv",
    "gps_events": "json",
    "sensor_events": "json",
    "delivery_events": "json",
}

BATCH_SOURCES = ("shipment_manifests", "invoices", "maintenance_logs", "driver_vehicle_master")
EVENT_SOURCES = ("gps_events", "sensor_events", "delivery_events")

# columns added by ingestion
INGEST_METADATA_DDL = "_ingested_at timestamp, _source_file string, _source_name string"


def schema(name: str) -> StructType:
    return StructType.fromDDL(SOURCE_DDL[name])


def bronze_schema(name: str) -> StructType:
    return StructType.fromDDL(SOURCE_DDL[name] + ", " + INGEST_METADATA_DDL)
