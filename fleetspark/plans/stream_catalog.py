"""Registered streaming queries.

Each runs a Structured Streaming query to completion (available-now trigger)
into a fresh folder under the shared checkpoint root, then returns a batch
read of the result. Sources are the supplied parquet tables read as file
streams (or files Spark derives from them: JSON/CSV landing drops).
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.types import StructType

from fleetspark import schemas
from fleetspark.operators import topk
from fleetspark.plans import gold, jobs, oracle, registry, silver
from fleetspark.plans import standins as T
from fleetspark.plans.catalog import LIVE_BOUND_SECONDS, ntz, rounded
from fleetspark.session import fresh_dir
from fleetspark.sources import ingest
from fleetspark.sources.tables import BATCH, TableNames, read_static
from fleetspark.streaming import bucketed, runner, scd_stream


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One supplied table as a file stream (schema taken from the table)."""
    schema = T.table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def _run_append(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    out, ckpt = fresh_dir(spark, f"{name}-out"), fresh_dir(spark, f"{name}-ckpt")
    runner.run_append(df, out, ckpt, query_name=None)
    return spark.read.schema(df.schema).parquet(out)


def _run_complete(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    out, ckpt = fresh_dir(spark, f"{name}-out"), fresh_dir(spark, f"{name}-ckpt")
    runner.run_complete(df, out, ckpt)
    return runner.read_complete(spark, out)


def _run_upsert(spark: SparkSession, df: DataFrame, keys: list[str], name: str) -> DataFrame:
    out, ckpt = fresh_dir(spark, f"{name}-out"), fresh_dir(spark, f"{name}-ckpt")
    runner.run_upsert(df, keys, out, ckpt, buckets=8)
    return runner.read_upserts(spark, out)


# --- I1, I2 -------------------------------------------------------------------------
def q_gps_dedup_stream(spark, d):
    """Every event is delivered twice (two sources over the same file); the
    silver dedup within the watermark must keep one copy."""
    twice = table_stream(spark, d, "events").unionByName(table_stream(spark, d, "events"))
    return ntz(_run_append(spark, silver.gps_events_silver(T.gps_events(twice)), "gps_dedup"))


# --- D3, I3, I7 ----------------------------------------------------------------------
def q_delivery_performance_stream(spark, d):
    ev = table_stream(spark, d, "events")
    out = gold.delivery_performance_gold(silver.delivery_events_silver(T.delivery_events(ev)))
    return ntz(_run_append(spark, out, "delivery_perf"))


# --- C1 on a stream (stream-static left join) ------------------------------------------
def q_shipment_invoice_stream(spark, d):
    """Each micro-batch of manifests reads only the invoices of its key buckets."""
    manifests = T.manifests(table_stream(spark, d, "orders"))
    invoices = T.invoices(table_stream(spark, d, "lineitem"))
    copy, copied, out, ckpt = (fresh_dir(spark, f"ship_stream-{part}") for part in ("by-key", "by-key-ckpt", "out", "ckpt"))
    bucketed.fill(invoices, "manifest_id", copy, copied, buckets=32)
    join = bucketed.joining(spark, copy, invoices.schema, "manifest_id", silver.shipment_invoice_silver, buckets=32)
    runner.run_update_batches(manifests, lambda batch, e: runner.write_once(join(runner.kept_aside(batch, f"{copy}-in/{e}")), f"{out}/{BATCH}={e}"), ckpt)
    return read_static(spark, out)


# --- I5: unbounded aggregate, complete mode via foreachBatch ---------------------------
def q_daily_revenue_stream(spark, d):
    manifests = T.manifests(table_stream(spark, d, "orders"))
    invoices = T.invoices(T.table(spark, d, "lineitem"))
    rev = gold.daily_revenue_gold(silver.shipment_invoice_silver(manifests, invoices))
    return rounded(_run_upsert(spark, rev, gold.REVENUE_KEYS, "daily_revenue"), "revenue")


# --- I6 ------------------------------------------------------------------------------
def q_active_alerts_stream(spark, d):
    sensor = silver.sensor_events_silver(T.sensor_events(table_stream(spark, d, "events")))
    return ntz(_run_append(spark, gold.active_alerts_gold(sensor, with_detected_at=False), "alerts"))


# --- C4, I4: stream-stream interval join ----------------------------------------------
def q_live_fleet_status_stream(spark, d):
    gps = silver.gps_events_silver(T.gps_events(table_stream(spark, d, "events")))
    sensor = silver.sensor_events_silver(T.sensor_events(table_stream(spark, d, "events")))
    out = gold.live_fleet_status_gold(gps, sensor, LIVE_BOUND_SECONDS)
    return ntz(_run_append(spark, out, "live_status"))


# --- C2 + I5: aggregated stream x static left join, complete mode --------------------
def q_vehicle_scorecard_stream(spark, d):
    maint = silver.maintenance_logs_silver(T.maintenance_logs(table_stream(spark, d, "lineitem")))
    current = silver.driver_vehicle_master_current(T.master_snapshots(T.table(spark, d, "events")))
    return rounded(_run_complete(spark, gold.vehicle_scorecard_gold(maint, current), "scorecard"), "total_maintenance_cost_inr")


# --- C3 + D4 on a stream: static sensor side pre-aggregated, gps streamed --------------
def q_fuel_cost_efficiency_stream(spark, d):
    from fleetspark.plans.catalog import _sensor_silver

    gps = silver.gps_events_silver(T.gps_events(table_stream(spark, d, "events")))
    return _run_upsert(spark, gold.fuel_cost_efficiency_gold(_sensor_silver(spark, d), gps), ["trip_id"], "fuel")


# --- C5 on a stream: nearest reading per ping, emitted once the ping is closed ----------
def q_nearest_reading_stream(spark, d):
    gps = silver.gps_events_silver(T.gps_events(table_stream(spark, d, "events")))
    sensor = silver.sensor_events_silver(T.sensor_events(table_stream(spark, d, "events")))
    out = gold.live_fleet_status_nearest(gps, sensor, LIVE_BOUND_SECONDS)
    return ntz(_run_append(spark, out, "nearest"))


# --- K5: incremental SCD2 with a late half --------------------------------------------
SCD_CUT, SCD_VERY_LATE = "2024-01-15", "2024-01-08"


def q_scd2_stream(spark, d):
    """Snapshots arrive in three drops, the *later* half first: the second run
    must re-open versions around the late rows, the third brings a very late
    week of some users. Available-now runs on one checkpoint (restarts in between)."""
    events = T.table(spark, d, "events")
    landing = fresh_dir(spark, "scd_landing")
    target, ckpt = fresh_dir(spark, "scd_target"), fresh_dir(spark, "scd_ckpt")
    late = F.coalesce(F.col("ts") < F.lit(SCD_CUT).cast("timestamp_ntz"), F.lit(True))
    very_late = late & F.coalesce(F.col("ts") < F.lit(SCD_VERY_LATE).cast("timestamp_ntz"), F.lit(False)) & (F.col("user_id") % 10 == 3)
    for drop in (~late, late & ~very_late, very_late):
        events.where(F.coalesce(drop, F.lit(False))).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(events.schema).parquet(landing)
        scd_stream.scd2_incremental(
            spark, stream, target, ckpt, ["user_id"], "ts", track=["event_type"], buckets=16
        )
    return scd_stream.read_history(spark, target).select(*events.columns, "__START_AT", "__END_AT")


# --- A1-A6: landing drops -> bronze, exactly once across re-runs -----------------------
NTZ_FMT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _ingest_roundtrip(spark, d, table_name, fmt):
    src = T.table(spark, d, table_name)
    landing = fresh_dir(spark, f"landing-{table_name}")
    bronze, ckpt = fresh_dir(spark, f"bronze-{table_name}"), fresh_dir(spark, f"ckpt-{table_name}")
    w = src.write.mode("append").option("timestampNTZFormat", NTZ_FMT)
    (w.option("header", "true").csv(landing) if fmt == "csv" else w.json(landing))
    opts = {"timestampNTZFormat": NTZ_FMT}
    # Two runs on one checkpoint: the second finds no new file and adds nothing.
    for _ in range(2):
        ingest.ingest_source(spark, table_name, landing, bronze, ckpt, fmt=fmt, schema=src.schema, options=opts)
    b = spark.read.parquet(bronze)
    return b.select(*src.columns, F.col("_source_file").isNotNull().alias("has_source_file"), "_source_name")


def q_bronze_csv_ingest(spark, d):
    return _ingest_roundtrip(spark, d, "orders", "csv")


def q_bronze_json_ingest(spark, d):
    return _ingest_roundtrip(spark, d, "events", "json")


# --- A7, A8, A13: concurrent event ingests, then counts --------------------------------
def q_bronze_stream_counts(spark, d):
    events = T.table(spark, d, "events")
    root = fresh_dir(spark, "stream-landing")
    bronze, ckpts = fresh_dir(spark, "stream-bronze"), fresh_dir(spark, "stream-ckpt")
    producers = {"gps_events": T.gps_events, "sensor_events": T.sensor_events, "delivery_events": T.delivery_events}
    for name, adapt in producers.items():
        adapt(events).write.mode("append").json(f"{root}/{name}")
    queries = ingest.start_stream_ingestion(spark, root, bronze, ckpts)
    ingest.await_all(queries)
    status = ingest.stream_status(queries)
    if any(s["active"] for s in status):
        raise RuntimeError(f"ingest still active: {status}")
    ingest.stop_all(queries)
    return ingest.table_counts(spark, {n: f"{bronze}/{n}" for n in producers}, tolerate_missing=False)


# --- M1-M4, A6: the batch sources under their declared schemas --------------------------
#: Rows of a landed file at most.
LANDED_ROWS = 250_000
#: Blanks at the ends of values are data.
CSV_WRITE = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

PRODUCERS = {
    "shipment_manifests": ("orders", T.manifests), "invoices": ("lineitem", T.invoices),
    "maintenance_logs": ("lineitem", T.maintenance_logs), "driver_vehicle_master": ("events", T.master_snapshots),
    "gps_events": ("events", T.gps_events), "sensor_events": ("events", T.sensor_events),
    "delivery_events": ("events", T.delivery_events),
}


def _land(spark, d, root, names):
    """Files of the named sources, with their declared columns and types, as their producers drop them: compressed, and bounded in
    length, as a compressed file is read by one task."""
    for name in names:
        table_name, adapt = PRODUCERS[name]
        rows = adapt(T.table(spark, d, table_name))
        rows = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.schema(name).fields])
        w = rows.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", LANDED_ROWS).format(schemas.SOURCE_FORMAT[name])
        (w.options(**CSV_WRITE) if schemas.SOURCE_FORMAT[name] == "csv" else w).save(f"{root}/{name}")


def _bronze_of(name):
    def q(spark, d):
        root, bronze, ckpt = (fresh_dir(spark, f"{name}-{part}") for part in ("landing", "bronze", "ckpt"))
        _land(spark, d, root, [name])
        found = ingest.ingest_batch_sources(spark, root, bronze, ckpt, [name])[name]
        return spark.read.parquet(found).drop("_ingested_at", "_source_file")

    return q


# --- O4 in ingestion: unknown fields and broken records are kept -------------------------
def q_bronze_rescue_ingest(spark, d):
    """Events as JSON, read with a schema that lacks value and props; records of errors are cut off."""
    ev = T.table(spark, d, "events")
    root, bronze, ckpt = (fresh_dir(spark, f"rescue-{part}") for part in ("landing", "bronze", "ckpt"))
    whole = F.to_json(F.struct("event_id", "user_id", "event_type", "value", "props"))
    cut = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"))
    ev.select(F.when(F.col("event_type") == "error", cut).otherwise(whole).alias("value")).write.text(root)
    known = StructType.fromDDL("event_id long, user_id long, event_type string")
    ingest.ingest_source(spark, "events", root, bronze, ckpt, fmt="json", schema=known, rescue=True)
    return spark.read.parquet(bronze).select(
        "event_id", "user_id", "event_type", F.get_json_object("_rescued_data", "$.value").cast("double").alias("rescued_value"),
        F.get_json_object("_rescued_data", "$.props").alias("rescued_props"), F.col("_corrupt_record").alias("corrupt"),
    )


# --- A11, A12: landing files read back without a schema ----------------------------------
def _read_back(name):
    def q(spark, d):
        root = fresh_dir(spark, f"readback-{name}")
        _land(spark, d, root, [name])
        return ingest.read_landing_batch(spark, f"{root}/{name}", schemas.SOURCE_FORMAT[name])

    return q


# --- F2: a few landed rows, whichever -----------------------------------------------------
def q_landing_preview(spark, d):
    """How many rows a preview of the landed manifests shows, and how many of those were landed."""
    root = fresh_dir(spark, "preview")
    _land(spark, d, root, ["shipment_manifests"])
    shown = topk.preview(ingest.read_landing_batch(spark, f"{root}/shipment_manifests", "json"), 5)
    keys = T.table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("manifest_id"))
    known = shown.join(keys, "manifest_id", "left_semi").agg(F.count(F.lit(1)).alias("rows_known"))
    return known.select(F.lit(shown.count()).cast("long").alias("rows_shown"), "rows_known")


# --- A9, A10, A14, A15: whole jobs through named tables ----------------------------------
def _job(spark, d, run, names):
    root, lake, ckpt = (fresh_dir(spark, f"job-{part}") for part in ("landing", "lake", "ckpt"))
    _land(spark, d, root, names)
    return run(spark, root, lake, ckpt)


def q_batch_job_revenue(spark, d):
    """The result is read by its name."""
    _job(spark, d, partial(jobs.run_batch_job, purge=True), schemas.BATCH_SOURCES)
    name = TableNames.from_session(spark, "").spark_name(spark, "gold", "daily_revenue_gold")
    return rounded(spark.table(name), "revenue")


def q_batch_job_rules(spark, d):
    """Counts of the rules and number of rows kept aside, of both silver tables with rules."""
    out = _job(spark, d, partial(jobs.run_batch_job, purge=True), schemas.BATCH_SOURCES)
    parts = []
    for name in ("shipment_invoice_silver", "maintenance_logs_silver"):
        kept = spark.read.parquet(out[f"quarantine.{name}"]).agg(F.count(F.lit(1)).alias("quarantined_rows"))
        own = [r.name for r in registry.DATASETS[name].rules.rules]
        counts = jobs.rule_counts(spark, out[f"rules.{name}"]).where(F.col("rule").isin(own))
        parts.append(counts.select(F.lit(name).alias("dataset"), "*", kept.scalar().alias("quarantined_rows")))
    return parts[0].unionByName(parts[1])


def q_stream_job_delivery(spark, d):
    out = _job(spark, d, jobs.run_stream_job, schemas.EVENT_SOURCES)
    return ntz(spark.read.parquet(out["gold.delivery_performance_gold"]))


def q_stream_job_ledger(spark, d):
    """What became of every landed event, each class from the job's tables. Every tenth event lands twice, every
    thirteenth without a time."""
    root, lake, ckpt = (fresh_dir(spark, f"ledger-{part}") for part in ("landing", "lake", "ckpt"))
    ev = T.table(spark, d, "events")
    for name in schemas.EVENT_SOURCES:
        rows = PRODUCERS[name][1](ev)
        twice = PRODUCERS[name][1](ev.where("event_id % 10 = 0"))
        lost = PRODUCERS[name][1](ev.where("event_id % 13 = 0")).withColumn("timestamp", F.lit("never"))
        rows = rows.unionByName(twice).unionByName(lost)
        rows = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.schema(name).fields])
        rows.write.mode("append").json(f"{root}/{name}")
    return jobs.event_ledger(spark, jobs.run_stream_job(spark, root, lake, ckpt))


# --- O4 for CSV: columns added, missing and in another order -------------------------------
def q_csv_schema_drift(spark, d):
    """Invoices in three layouts: as declared; with a new second column; without the status and in another order."""
    inv = T.invoices(T.table(spark, d, "lineitem"))
    root, bronze, ckpt = (fresh_dir(spark, f"drift-{part}") for part in ("landing", "bronze", "ckpt"))
    names = [f.name for f in schemas.schema("invoices").fields]
    kind = F.pmod(F.col("manifest_id"), F.lit(3))
    layouts = [names, [names[0], "region", *names[1:]], ["amount_inr", "manifest_id", "customer_name", "invoice_id", "invoice_date"]]
    for i, layout in enumerate(layouts):
        part = inv.where(kind == i).withColumn("region", F.concat(F.lit("NORTH, "), F.col("customer_name")))
        part.select(*layout).write.mode("append").options(**CSV_WRITE).csv(f"{root}/invoices")
    ingest.ingest_batch_sources(spark, root, bronze, ckpt, ["invoices"], rescue=True)
    rows = read_static(spark, f"{bronze}/invoices")
    return rows.select(*names, "_rescued_data", F.col("_corrupt_record").isNotNull().alias("is_corrupt"))


STREAM_QUERIES = {
    "bronze_manifests": _bronze_of("shipment_manifests"),
    "bronze_invoices": _bronze_of("invoices"),
    "bronze_maintenance": _bronze_of("maintenance_logs"),
    "bronze_master": _bronze_of("driver_vehicle_master"),
    "bronze_rescue_ingest": q_bronze_rescue_ingest,
    "landing_json_inferred": _read_back("delivery_events"),
    "landing_csv_strings": _read_back("maintenance_logs"),
    "batch_job_revenue": q_batch_job_revenue,
    "batch_job_rules": q_batch_job_rules,
    "stream_job_delivery": q_stream_job_delivery,
    "landing_preview": q_landing_preview,
    "stream_job_ledger": q_stream_job_ledger,
    "csv_schema_drift": q_csv_schema_drift,
    "gps_dedup_stream": q_gps_dedup_stream,
    "delivery_performance_stream": q_delivery_performance_stream,
    "shipment_invoice_stream": q_shipment_invoice_stream,
    "daily_revenue_stream": q_daily_revenue_stream,
    "active_alerts_stream": q_active_alerts_stream,
    "live_fleet_status_stream": q_live_fleet_status_stream,
    "scd2_stream": q_scd2_stream,
    "vehicle_scorecard_stream": q_vehicle_scorecard_stream,
    "fuel_cost_efficiency_stream": q_fuel_cost_efficiency_stream,
    "nearest_reading_stream": q_nearest_reading_stream,
    "bronze_csv_ingest": q_bronze_csv_ingest,
    "bronze_json_ingest": q_bronze_json_ingest,
    "bronze_stream_counts": q_bronze_stream_counts,
}

B = oracle.BATCH_SQL
_SHIP_FAILS = "SELECT count(*) FROM joined WHERE NOT (" + oracle.SHIP_OK + ")"
_MAINT_FAILS = "SELECT count(*) FROM maint WHERE NOT (coalesce(cost_inr > 0, false) AND coalesce(odometer_km > 0, false))"
STREAM_SQL = {
    "bronze_manifests": oracle.with_(oracle.MANIFESTS)
    + """SELECT * REPLACE (CAST(manifest_id AS VARCHAR) AS manifest_id, CAST(vehicle_id AS VARCHAR) AS vehicle_id),
       'shipment_manifests' AS _source_name FROM manifests""",
    "bronze_invoices": oracle.with_(oracle.INVOICES)
    + "SELECT * REPLACE (CAST(manifest_id AS VARCHAR) AS manifest_id), 'invoices' AS _source_name FROM invoices",
    "bronze_maintenance": oracle.with_(oracle.MAINT)
    + "SELECT * REPLACE (CAST(vehicle_id AS VARCHAR) AS vehicle_id), 'maintenance_logs' AS _source_name FROM maint",
    "bronze_master": oracle.with_(oracle.MASTER)
    + "SELECT * REPLACE (CAST(vehicle_id AS VARCHAR) AS vehicle_id), 'driver_vehicle_master' AS _source_name FROM master",
    "bronze_rescue_ingest": """SELECT CASE WHEN ok THEN event_id END AS event_id, CASE WHEN ok THEN user_id END AS user_id,
       CASE WHEN ok THEN event_type END AS event_type, CASE WHEN ok THEN value END AS rescued_value,
       CASE WHEN ok THEN props END AS rescued_props, CASE WHEN NOT ok THEN '{"event_id":' || event_id END AS corrupt
FROM (SELECT *, event_type IS DISTINCT FROM 'error' AS ok FROM events)""",
    "landing_json_inferred": oracle.with_(oracle.DELIVERY.replace(" WHERE ts IS NOT NULL", ""))
    + "SELECT * EXCLUDE (event_timestamp) REPLACE (CAST(vehicle_id AS VARCHAR) AS vehicle_id) FROM delivery",
    "landing_csv_strings": oracle.with_(oracle.MAINT)
    + "SELECT CAST(COLUMNS(*) AS VARCHAR) FROM maint",
    "batch_job_revenue": B["daily_revenue"],
    "batch_job_rules": oracle.with_(oracle.MANIFESTS, oracle.INVOICES, oracle.JOINED, oracle.MAINT)
    + f"""SELECT 'shipment_invoice_silver' AS dataset, r.*, ({_SHIP_FAILS}) AS quarantined_rows
FROM ({oracle._report([*oracle.SHIP_RULES], 'joined')}) r
UNION ALL SELECT 'maintenance_logs_silver', r.*, ({_MAINT_FAILS})
FROM ({oracle._report([('valid_cost', 'drop', 'cost_inr > 0'), ('valid_odometer_km', 'drop', 'odometer_km > 0')], 'maint')}) r""",
    "gps_dedup_stream": B["gps_silver"],
    "delivery_performance_stream": oracle.with_(oracle.DELIVERY, oracle.DELIVERY_SILVER)
    + """SELECT date_trunc('hour', event_timestamp) AS window_start,
       date_trunc('hour', event_timestamp) + INTERVAL 1 HOUR AS window_end, status, count(*) AS event_count
FROM delivery_silver WHERE event_timestamp IS NOT NULL AND status IS NOT NULL
GROUP BY 1, 2, 3
HAVING date_trunc('hour', event_timestamp) + INTERVAL 1 HOUR
       <= (SELECT max(event_timestamp) FROM delivery) - INTERVAL 10 MINUTE""",
    "shipment_invoice_stream": B["shipment_invoice_silver"],
    "daily_revenue_stream": B["daily_revenue"],
    "active_alerts_stream": B["active_alerts"],
    "live_fleet_status_stream": B["live_fleet_status"],
    "scd2_stream": B["scd2_tracked"],
    "vehicle_scorecard_stream": B["vehicle_scorecard"],
    "fuel_cost_efficiency_stream": B["fuel_cost_efficiency"],
    # A ping is emitted once the aggregate's watermark passes it: the input
    # watermark (min over both sides of max event time - 2 min) less the join's
    # time bound, because the join can still produce pairs that far back.
    "nearest_reading_stream": B["nearest_reading"].replace(
        "SELECT * FROM pairs\n",
        f"""SELECT * FROM pairs
WHERE event_timestamp <= least((SELECT max(ts) FROM events WHERE event_type = 'view'),
                               (SELECT max(ts) FROM events WHERE event_type = 'click'))
      - INTERVAL 2 MINUTE - INTERVAL {LIVE_BOUND_SECONDS} SECOND
""",
    ),
    "bronze_csv_ingest": "SELECT *, true AS has_source_file, 'orders' AS _source_name FROM orders",
    "bronze_json_ingest": "SELECT *, true AS has_source_file, 'events' AS _source_name FROM events",
    "bronze_stream_counts": """SELECT 'gps_events' AS table_name, count(*) AS row_count FROM events WHERE event_type = 'view'
UNION ALL SELECT 'sensor_events', count(*) FROM events WHERE event_type = 'click'
UNION ALL SELECT 'delivery_events', count(*) FROM events""",
}
_LANDED = """landed AS (SELECT 'gps_events_silver' AS dataset, user_id, ts, event_id, lat BETWEEN 8.0 AND 37.0 AND lon BETWEEN 68.0 AND 97.0 AND value BETWEEN 0 AND 150 AS ok
  FROM (SELECT *, 7.5 + value / 8 AS lat, 68.0 + value / 4 AS lon FROM events) WHERE event_type = 'view'
  UNION ALL SELECT 'sensor_events_silver', user_id, ts, event_id, value - 20 BETWEEN -20 AND 150 AND value BETWEEN 0 AND 200 AND (user_id % 2 = 0 OR value / 2 - 30 BETWEEN -30 AND 50)
  FROM events WHERE event_type = 'click'
  UNION ALL SELECT 'delivery_events_silver', user_id, ts, event_id, event_type IN ('signup', 'click', 'view', 'purchase') FROM events)"""
STREAM_SQL["stream_job_ledger"] = f"""WITH {_LANDED},
once AS (SELECT dataset, user_id, ts, any_value(ok) AS ok, count(*) + count(*) FILTER (event_id % 10 = 0) AS n FROM landed WHERE ts IS NOT NULL GROUP BY ALL),
lost AS (SELECT dataset, count(*) FILTER (event_id % 13 = 0) + count(*) FILTER (ts IS NULL) + count(*) FILTER (ts IS NULL AND event_id % 10 = 0) AS n FROM landed GROUP BY dataset)
SELECT once.dataset, (sum(once.n) + any_value(lost.n))::BIGINT AS bronze_rows, count(*) FILTER (ok) AS kept_rows, count(*) FILTER (ok IS NOT TRUE) AS refused_rows,
       any_value(lost.n)::BIGINT AS untimed_rows, (sum(once.n) - count(*))::BIGINT AS duplicate_rows, 0::BIGINT AS late_rows, 0::BIGINT AS foreign_rows, 0::BIGINT AS unexplained_rows
FROM once JOIN lost ON lost.dataset = once.dataset GROUP BY once.dataset"""
STREAM_SQL["landing_preview"] = "SELECT least(5, count(*)) AS rows_shown, least(5, count(*)) AS rows_known FROM orders"
STREAM_SQL["csv_schema_drift"] = oracle.with_(oracle.INVOICES) + """SELECT invoice_id, manifest_id::VARCHAR AS manifest_id, invoice_date, customer_name, amount_inr,
       CASE WHEN manifest_id % 3 <> 2 THEN payment_status END AS payment_status,
       CASE WHEN manifest_id % 3 = 1 THEN '{"region":"NORTH, ' || customer_name || '"}' END AS _rescued_data, false AS is_corrupt
FROM invoices"""
STREAM_SQL["stream_job_delivery"] = STREAM_SQL["delivery_performance_stream"]
