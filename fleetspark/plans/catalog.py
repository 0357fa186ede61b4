"""Registered queries over the supplied tables: name -> (spark, sf_dir) -> DataFrame.

Every query reads whole tables (no id subsets, no row caps; ``limit`` only in
the top-k report, where it is the feature). Timestamps leave as
TIMESTAMP_NTZ so results compare type-for-type with other engines; sums of
money are rounded on output only. The DuckDB equivalents live in ``fleetspark.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampType

from fleetspark.operators import governance, routes, scd, topk
from fleetspark.operators.expectations import FAILED_RULES_COL
from fleetspark.plans import gold, silver
from fleetspark.plans import standins as T

# Stand-in time bound for the live interval join: the supplied events are far
# sparser than 10-second ticks, so +/-30 minutes stands in for +/-30 seconds.
LIVE_BOUND_SECONDS = 1800


def ntz(df: DataFrame) -> DataFrame:
    """TIMESTAMP -> TIMESTAMP_NTZ on output (session time zone is UTC)."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def rounded(df: DataFrame, column: str) -> DataFrame:
    """Money sums rounded on output: the order of summation differs between engines, the cents don't."""
    return df.withColumn(column, F.round(column, 2))


# --- inputs ------------------------------------------------------------------------
def _manifests(spark, d):
    return T.manifests(T.table(spark, d, "orders"))


def _invoices(spark, d):
    return T.invoices(T.table(spark, d, "lineitem"))


def _events(spark, d):
    return T.table(spark, d, "events")


def _gps_silver(spark, d):
    return silver.gps_events_silver(T.gps_events(_events(spark, d)))


def _sensor_silver(spark, d):
    return silver.sensor_events_silver(T.sensor_events(_events(spark, d)))


def _delivery_silver(spark, d):
    return silver.delivery_events_silver(T.delivery_events(_events(spark, d)))


def _shipment_silver(spark, d):
    return silver.shipment_invoice_silver(_manifests(spark, d), _invoices(spark, d))


def _maintenance_silver(spark, d):
    return silver.maintenance_logs_silver(T.maintenance_logs(T.table(spark, d, "lineitem")))


def _master_history(spark, d, track_all=True):
    return silver.driver_vehicle_master_silver(T.master_snapshots(_events(spark, d)), track_all=track_all)


EVENT_KEYS = ["user_id"]


# --- batch queries -----------------------------------------------------------------
def q_shipment_invoice_silver(spark, d):
    return _shipment_silver(spark, d)


def q_daily_revenue(spark, d):
    return rounded(gold.daily_revenue_gold(_shipment_silver(spark, d)), "revenue")


def q_shipment_expectations_report(spark, d):
    prepared = silver.shipment_invoice_prepared(_manifests(spark, d), _invoices(spark, d))
    return silver.SHIPMENT_INVOICE_RULES.report(prepared)


def q_shipment_quarantine(spark, d):
    prepared = silver.shipment_invoice_prepared(_manifests(spark, d), _invoices(spark, d))
    q = silver.SHIPMENT_INVOICE_RULES.quarantine(prepared)
    return q.withColumn("failed_rules", F.array_join(F.col(FAILED_RULES_COL), ",")).drop(FAILED_RULES_COL)


def q_maintenance_silver(spark, d):
    return _maintenance_silver(spark, d)


def q_gps_silver(spark, d):
    return ntz(_gps_silver(spark, d))


def q_gps_expectations_report(spark, d):
    prepared = silver.gps_events_prepared(T.gps_events(_events(spark, d)))
    return silver.GPS_RULES.report(prepared)


def q_sensor_silver(spark, d):
    return ntz(_sensor_silver(spark, d))


def q_sensor_quarantine(spark, d):
    prepared = silver.sensor_events_prepared(T.sensor_events(_events(spark, d)))
    q = silver.SENSOR_RULES.quarantine(prepared)
    return ntz(q.withColumn("failed_rules", F.array_join(F.col(FAILED_RULES_COL), ",")).drop(FAILED_RULES_COL))


def q_delivery_silver(spark, d):
    return ntz(_delivery_silver(spark, d))


def q_scd2_all(spark, d):
    return scd.scd2(_events(spark, d), EVENT_KEYS, "ts")


def q_scd2_tracked(spark, d):
    return scd.scd2(_events(spark, d), EVENT_KEYS, "ts", track=["event_type"])


def q_scd2_current(spark, d):
    return scd.current_versions(scd.scd2(_events(spark, d), EVENT_KEYS, "ts", track=["event_type"]))


def q_scd1_latest(spark, d):
    return scd.scd1(_events(spark, d), EVENT_KEYS, "ts")


def q_master_scd2(spark, d):
    return _master_history(spark, d, track_all=True)


def q_master_scd2_tracked(spark, d):
    return _master_history(spark, d, track_all=False)


def q_vehicle_scorecard(spark, d):
    current = silver.driver_vehicle_master_current(T.master_snapshots(_events(spark, d)))
    return rounded(gold.vehicle_scorecard_gold(_maintenance_silver(spark, d), current), "total_maintenance_cost_inr")


def q_vehicle_scorecard_history(spark, d):
    """The scorecard through the open versions of the whole history."""
    return rounded(gold.vehicle_scorecard_gold(_maintenance_silver(spark, d), _master_history(spark, d)), "total_maintenance_cost_inr")


def q_vehicle_scorecard_asof(spark, d):
    """Service costs by the assignment valid on the service date."""
    found = gold.vehicle_scorecard_asof(_maintenance_silver(spark, d), _master_history(spark, d))
    return rounded(found, "total_maintenance_cost_inr")


VERSION_HOURS = 6


def q_asof_gaps(spark, d):
    """C6 over a history with gaps and tied starts: a click sets a value for six hours, twice at once."""
    ev = _events(spark, d)
    clicks = ev.where("event_type = 'click' and ts is not null")
    both = clicks.select("user_id", "ts", "value").union(clicks.select("user_id", "ts", F.col("value") + 1))
    history = both.select(
        "user_id", F.col("value").alias("level"), F.col("ts").alias(scd.START_AT), (F.col("ts") + F.make_dt_interval(hours=F.lit(VERSION_HOURS))).alias(scd.END_AT)
    )
    facts = ev.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return scd.asof_join(facts, history, "user_id", "user_id", "ts", ["level", scd.START_AT])


def q_gps_dedup_batch(spark, d):
    """I2 in batch over events that are all delivered twice, the second time with another value."""
    ev = _events(spark, d)
    twice = ev.unionByName(ev.withColumn("value", F.col("value") + 1))
    return ntz(silver.gps_events_prepared(T.gps_events(twice)))


def q_event_time_quarantine(spark, d):
    """Pings whose time can't be parsed (here: of the southernmost positions) are kept aside before the dedup."""
    gps = T.gps_events(_events(spark, d).where("ts is not null"))
    broken = gps.withColumn("timestamp", F.when(F.col("lat") < 8, F.concat(F.lit("at "), "timestamp")).otherwise(F.col("timestamp")))
    q = silver.EVENT_TIME_RULES.quarantine(silver.with_event_time(broken)).drop("event_timestamp")
    return q.withColumn("failed_rules", F.array_join(F.col(FAILED_RULES_COL), ",")).drop(FAILED_RULES_COL)


def q_asof_dimension_join(spark, d):
    ev = _events(spark, d)
    facts = ev.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts", "value")
    history = scd.scd2(ev.where(F.col("event_type") != "purchase"), EVENT_KEYS, "ts", track=["event_type"])
    return scd.asof_join(facts, history, "user_id", "user_id", "ts", ["event_type", scd.START_AT])


def q_active_alerts(spark, d):
    return ntz(gold.active_alerts_gold(_sensor_silver(spark, d), with_detected_at=False))


def q_delivery_performance(spark, d):
    return ntz(gold.delivery_performance_gold(_delivery_silver(spark, d)))


def q_fuel_cost_efficiency(spark, d):
    return gold.fuel_cost_efficiency_gold(_sensor_silver(spark, d), _gps_silver(spark, d))


def q_fuel_by_day_route(spark, d):
    return gold.fuel_by_day_route(_sensor_silver(spark, d), _gps_silver(spark, d))


def q_live_fleet_status(spark, d):
    return ntz(gold.live_fleet_status_gold(_gps_silver(spark, d), _sensor_silver(spark, d), LIVE_BOUND_SECONDS))


def q_nearest_reading(spark, d):
    return ntz(gold.live_fleet_status_nearest(_gps_silver(spark, d), _sensor_silver(spark, d), LIVE_BOUND_SECONDS))


def q_latest_events_topk(spark, d):
    """the 10 newest events (event id breaks ties)."""
    return topk.latest(_events(spark, d), "ts", 10, ["event_id"])


#: Key of the registered query; a deployment sets its own in the session.
MASKING_KEY = "registered-query"


def q_master_masked(spark, d):
    """O2: master snapshots as a reader of the test environment sees them (personal columns hashed with a key)."""
    return governance.mask_for_environment(T.master_snapshots(_events(spark, d)), "uat", key=MASKING_KEY)


def q_master_redacted(spark, d):
    """O2: the same for a production reader (all but the last characters starred)."""
    return governance.mask_for_environment(T.master_snapshots(_events(spark, d)), "prod")


# Grants are configuration, not data: a handful of (principal, route) pairs, whatever the size of the fleet data.
GRANTS = [("ops_pune", "ROUTE_MUM_PUNE"), ("ops_pune", "ROUTE_PUNE_NASHIK_AURANGABAD"), ("ops_pune", "ROUTE_MUM_PUNE"),
          ("ops_nashik", "ROUTE_MUM_NASHIK")]


def q_gps_row_security(spark, d):
    """O3: gps silver restricted to the routes granted to one principal."""
    return ntz(governance.restrict_rows_to(_gps_silver(spark, d), GRANTS, "ops_pune", "route_name"))


def q_events_schema_evolution(spark, d):
    """Events landed as JSON text, parsed with a schema that lacks two of
    their fields; the unknown fields survive in the rescue map."""
    from fleetspark.sources.evolution import RESCUE_COL, parse_with_rescue

    ev = _events(spark, d)
    opts = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    text = ev.select(F.to_json(F.struct(*[F.col(c) for c in ev.columns]), opts).alias("value"))
    known = StructType([f for f in ev.schema.fields if f.name not in ("value", "props")])
    parsed = parse_with_rescue(text, known, options=opts)
    return parsed.select(
        "event_id", "ts", "user_id", "event_type",
        F.array_join(F.array_sort(F.map_keys(RESCUE_COL)), ",").alias("rescued_keys"),
        F.col(RESCUE_COL)["value"].cast("double").alias("rescued_value"),
        F.col(RESCUE_COL)["props"].alias("rescued_props"),
    )


SUPPLIED_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                   "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def q_table_counts(spark, d):
    from fleetspark.sources.ingest import table_counts

    return table_counts(spark, {t: f"{d.rstrip('/')}/{t}.parquet" for t in SUPPLIED_TABLES}, tolerate_missing=False)


def q_ping_step_distance(spark, d):
    gps = _gps_silver(spark, d).select("trip_id", "event_timestamp", "lat", "lon")
    steps = routes.with_step_distance(gps, ["trip_id"], "event_timestamp")
    return ntz(steps.select("trip_id", "event_timestamp", F.round("step_km", 6).alias("step_km")))


def q_trip_distance(spark, d):
    gps = _gps_silver(spark, d).select("trip_id", "event_timestamp", "lat", "lon")
    out = routes.trip_distance(gps, ["trip_id"], "event_timestamp")
    return out.select("trip_id", "pings", F.round("total_km", 6).alias("total_km"))


def q_route_position(spark, d):
    gps = _gps_silver(spark, d).select("trip_id", "event_timestamp", "route_name", "distance_traveled_km")
    return ntz(routes.position_on_route(gps, "route_name", "distance_traveled_km"))


def q_route_eta(spark, d):
    trips = _gps_silver(spark, d).select("trip_id", "route_name").distinct()
    return routes.hours_for_route(trips, "route_name")


BATCH_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "shipment_invoice_silver": q_shipment_invoice_silver,
    "daily_revenue": q_daily_revenue,
    "shipment_expectations_report": q_shipment_expectations_report,
    "shipment_quarantine": q_shipment_quarantine,
    "maintenance_silver": q_maintenance_silver,
    "gps_silver": q_gps_silver,
    "gps_expectations_report": q_gps_expectations_report,
    "sensor_silver": q_sensor_silver,
    "sensor_quarantine": q_sensor_quarantine,
    "delivery_silver": q_delivery_silver,
    "scd2_all": q_scd2_all,
    "scd2_tracked": q_scd2_tracked,
    "scd2_current": q_scd2_current,
    "scd1_latest": q_scd1_latest,
    "master_scd2": q_master_scd2,
    "master_scd2_tracked": q_master_scd2_tracked,
    "vehicle_scorecard": q_vehicle_scorecard,
    "vehicle_scorecard_history": q_vehicle_scorecard_history,
    "vehicle_scorecard_asof": q_vehicle_scorecard_asof,
    "asof_gaps": q_asof_gaps,
    "gps_dedup_batch": q_gps_dedup_batch,
    "event_time_quarantine": q_event_time_quarantine,
    "asof_dimension_join": q_asof_dimension_join,
    "active_alerts": q_active_alerts,
    "delivery_performance": q_delivery_performance,
    "fuel_cost_efficiency": q_fuel_cost_efficiency,
    "fuel_by_day_route": q_fuel_by_day_route,
    "live_fleet_status": q_live_fleet_status,
    "nearest_reading": q_nearest_reading,
    "latest_events_topk": q_latest_events_topk,
    "table_counts": q_table_counts,
    "ping_step_distance": q_ping_step_distance,
    "trip_distance": q_trip_distance,
    "route_position": q_route_position,
    "route_eta": q_route_eta,
    "master_masked": q_master_masked,
    "master_redacted": q_master_redacted,
    "gps_row_security": q_gps_row_security,
    "events_schema_evolution": q_events_schema_evolution,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from fleetspark.plans.stream_catalog import STREAM_QUERIES

    return {**BATCH_QUERIES, **STREAM_QUERIES}
