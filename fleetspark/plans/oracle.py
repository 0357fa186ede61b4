"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written independently of the Spark plans: the literal, textbook form of each
operator (plain LEFT JOIN, LAG/LEAD over the whole key, the quadratic join
for fuel, ASOF JOIN for the as-of lookup). Stand-in views mirror
``fleetspark.plans.standins``.
"""

from __future__ import annotations

from fleetspark import constants as K
from fleetspark.plans.standins import CITY_NAMES, ROUTE_NAMES, STATUS_OF_EVENT


def _case_pick(names, idx_sql):
    return "CASE " + " ".join(f"WHEN {idx_sql} = {i} THEN '{n}'" for i, n in enumerate(names)) + " END"


ROUTE_OF = _case_pick(ROUTE_NAMES, "(user_id % 5)")
TRIP_ID = "CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR)"
ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'"

MANIFESTS = """manifests AS (
  SELECT o_orderkey AS manifest_id,
         CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS shipment_date,
         o_custkey AS vehicle_id,
         o_orderstatus AS route_name,
         CAST(o_custkey AS VARCHAR) AS customer_name,
         o_orderstatus AS destination_city,
         CAST(trunc(o_totalprice / 10000) AS INTEGER) AS package_count,
         (o_totalprice - 20000) / 100 AS total_weight_kg,
         o_orderstatus = 'F' AS is_cold_chain,
         o_orderpriority AS priority
  FROM orders)"""

INVOICES = """invoices AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS invoice_id,
         l_orderkey AS manifest_id,
         CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS invoice_date,
         CAST(l_suppkey AS VARCHAR) AS customer_name,
         CASE WHEN l_tax <> 0 THEN l_extendedprice END AS amount_inr,
         l_linestatus AS payment_status
  FROM lineitem)"""

JOINED = """joined AS (
  SELECT m.*, i.invoice_id, i.amount_inr, i.payment_status, i.invoice_id IS NOT NULL AS is_invoiced
  FROM manifests m LEFT JOIN invoices i ON m.manifest_id = i.manifest_id)"""

SHIP_OK = "coalesce(total_weight_kg > 0, false) AND coalesce(package_count > 0, false)"
SHIP_SILVER = f"ship AS (SELECT * FROM joined WHERE {SHIP_OK})"

MAINT = """maint AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS log_id,
         CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS service_date,
         l_suppkey AS vehicle_id,
         '  ' || l_returnflag || ' ' AS issue_type,
         CASE WHEN l_discount <> 0 THEN l_extendedprice ELSE 0.0 END AS cost_inr,
         (CAST(trunc(l_quantity) AS INTEGER) - 1) * 1000 AS odometer_km,
         ' ' || l_linestatus || '  ' AS service_center
  FROM lineitem)"""

MAINT_SILVER = """maint_silver AS (
  SELECT log_id, service_date, vehicle_id, trim(issue_type) AS issue_type, cost_inr, odometer_km,
         trim(service_center) AS service_center
  FROM maint WHERE coalesce(cost_inr > 0, false) AND coalesce(odometer_km > 0, false))"""

GPS = f"""gps AS (
  SELECT 'gps' AS event_type, {TRIP_ID} AS trip_id, user_id AS vehicle_id, 'D' || CAST(user_id AS VARCHAR) AS driver_id,
         {ISO} AS timestamp, 7.5 + value / 8 AS lat, 68.0 + value / 4 AS lon, value AS speed_kmph,
         props AS heading, value AS distance_traveled_km, {ROUTE_OF} AS route_name, ts AS event_timestamp
  FROM events WHERE event_type = 'view' AND ts IS NOT NULL)"""

GPS_RULES = [
    ("valid_latitude", "drop", f"lat BETWEEN {K.LAT_RANGE[0]} AND {K.LAT_RANGE[1]}"),
    ("valid_longitude", "drop", f"lon BETWEEN {K.LON_RANGE[0]} AND {K.LON_RANGE[1]}"),
    ("valid_speed", "drop", "speed_kmph >= 0 AND speed_kmph <= 150"),
    ("has_trip_id", "warn", "trip_id IS NOT NULL"),
]
GPS_OK = " AND ".join(f"coalesce({p}, false)" for _, a, p in GPS_RULES if a == "drop")
GPS_SILVER = f"gps_silver AS (SELECT * FROM gps WHERE {GPS_OK})"

SENSOR = f"""sensor AS (
  SELECT 'sensor' AS event_type, {TRIP_ID} AS trip_id, user_id AS vehicle_id, {ISO} AS timestamp,
         value - 20 AS engine_temp_c, value AS fuel_level_litres,
         CASE WHEN user_id % 2 = 1 THEN value / 2 - 30 END AS cargo_temp_c,
         CASE WHEN value > 120 THEN 'engine_overheat' WHEN value < 2 THEN 'fuel_drop' END AS anomaly_flag,
         ts AS event_timestamp
  FROM events WHERE event_type = 'click' AND ts IS NOT NULL)"""

SENSOR_RULES = [
    ("valid_engine_temp", f"engine_temp_c BETWEEN {K.ENGINE_TEMP_RANGE[0]} AND {K.ENGINE_TEMP_RANGE[1]}"),
    ("valid_fuel_level", f"fuel_level_litres BETWEEN {K.FUEL_RANGE[0]} AND {K.FUEL_RANGE[1]}"),
    ("valid_cargo_temp", f"cargo_temp_c IS NULL OR cargo_temp_c BETWEEN {K.CARGO_TEMP_RANGE[0]} AND {K.CARGO_TEMP_RANGE[1]}"),
]
SENSOR_OK = " AND ".join(f"coalesce({p}, false)" for _, p in SENSOR_RULES)
SENSOR_PREP = "sensor_prep AS (SELECT *, anomaly_flag IS NOT NULL AS is_critical_anomaly FROM sensor)"
SENSOR_SILVER = f"sensor_silver AS (SELECT * FROM sensor_prep WHERE {SENSOR_OK})"

_STATUS = "CASE " + " ".join(f"WHEN event_type = '{e}' THEN '{s}'" for e, s in STATUS_OF_EVENT.items()) + " ELSE 'exception' END"
_ORDER = "CASE " + " ".join(f"WHEN status = '{s}' THEN {o}" for s, o in K.DELIVERY_STATE_ORDER.items()) + " END"
_STATES = ", ".join(f"'{s}'" for s in K.DELIVERY_STATE_ORDER)
DELIVERY = f"""delivery AS (
  SELECT 'delivery' AS event_type, {TRIP_ID} AS trip_id, user_id AS vehicle_id, {ISO} AS timestamp,
         {_STATUS} AS status, {_case_pick(CITY_NAMES, '(user_id % 5)')} AS location_city, ts AS event_timestamp
  FROM events WHERE ts IS NOT NULL)"""
DELIVERY_SILVER = f"""delivery_silver AS (
  SELECT event_type, trip_id, vehicle_id, timestamp, status, location_city, event_timestamp, {_ORDER} AS status_order
  FROM delivery WHERE coalesce(status IN ({_STATES}), false))"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _report(rules, source):
    parts = []
    for name, action, pred in rules:
        fail = f"sum(CASE WHEN coalesce({pred}, false) THEN 0 ELSE 1 END)"
        parts.append(
            f"SELECT '{name}' AS rule, '{action}' AS action, CAST(count(*) - {fail} AS BIGINT) AS passed_rows, "
            f"CAST({fail} AS BIGINT) AS failed_rows FROM {source}"
        )
    return "\nUNION ALL\n".join(parts)


def _failed_list(rules):
    return "concat_ws(',', " + ", ".join(f"CASE WHEN NOT coalesce({p}, false) THEN '{n}' END" for n, p in rules) + ")"


SHIP_RULES = [
    ("valid_weight", "drop", "total_weight_kg > 0"),
    ("valid_package_count", "drop", "package_count > 0"),
    ("valid_amount", "warn", "amount_inr IS NOT NULL"),
]

EVENT_COLS = "event_id, ts, user_id, event_type, value, props"
EVENTS_TRACKED = """ev_prev AS (
  SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS prev_t,
         row_number() OVER (PARTITION BY user_id ORDER BY ts) AS rn
  FROM events WHERE ts IS NOT NULL),
ev_changes AS (SELECT * FROM ev_prev WHERE rn = 1 OR prev_t IS DISTINCT FROM event_type),
ev_hist AS (
  SELECT event_id, ts, user_id, event_type, value, props, ts AS __START_AT,
         lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS __END_AT
  FROM ev_changes)"""

MASTER_COLS = [
    "license_plate", "vehicle_type", "driver_id", "driver_name", "driver_phone", "driver_license_no",
    "home_route", "is_active", "last_change_type",
]
MASTER = f"""master AS (
  SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS snapshot_date, user_id AS vehicle_id,
         'MH-' || CAST(user_id AS VARCHAR) AS license_plate, event_type AS vehicle_type,
         'D' || CAST(CAST(floor(value / 50) AS BIGINT) AS VARCHAR) AS driver_id,
         'driver-' || CAST(CAST(floor(value / 50) AS BIGINT) AS VARCHAR) AS driver_name,
         '9' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS driver_phone, 'DL-' || CAST(user_id AS VARCHAR) AS driver_license_no,
         {ROUTE_OF} AS home_route, value >= 1 AS is_active, props AS last_change_type
  FROM events),
master_dedup AS (
  SELECT * FROM master
  QUALIFY row_number() OVER (PARTITION BY vehicle_id, snapshot_date
                             ORDER BY {', '.join(c + ' DESC NULLS LAST' for c in MASTER_COLS)}) = 1)"""
MASTER_ALL_HIST = """master_hist AS (
  SELECT *, snapshot_date AS __START_AT,
         lead(snapshot_date) OVER (PARTITION BY vehicle_id ORDER BY snapshot_date) AS __END_AT
  FROM master_dedup)"""
_TRACKED_MASTER = [c for c in MASTER_COLS if c != "last_change_type"]
MASTER_TRACKED_HIST = f"""master_prev AS (
  SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY snapshot_date) AS rn,
         {', '.join(f'lag({c}) OVER (PARTITION BY vehicle_id ORDER BY snapshot_date) AS p_{c}' for c in _TRACKED_MASTER)}
  FROM master_dedup),
master_changes AS (
  SELECT * FROM master_prev
  WHERE rn = 1 OR {' OR '.join(f'{c} IS DISTINCT FROM p_{c}' for c in _TRACKED_MASTER)}),
master_thist AS (
  SELECT snapshot_date, vehicle_id, {', '.join(MASTER_COLS)}, snapshot_date AS __START_AT,
         lead(snapshot_date) OVER (PARTITION BY vehicle_id ORDER BY snapshot_date) AS __END_AT
  FROM master_changes)"""

HAVERSINE = (
    "2 * 6371.0 * asin(sqrt(pow(sin(radians({la2} - {la1}) / 2), 2) + "
    "cos(radians({la1})) * cos(radians({la2})) * pow(sin(radians({lo2} - {lo1}) / 2), 2)))"
)


def _dbl(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def _legs_values():
    """Route legs (route, seq, s_km, e_km, s_lat, s_lon, e_lat, e_lon, e_city, limit) from the constants."""
    seg = {frozenset((a, b)): (dist, lim) for a, b, dist, lim in K.ROAD_SEGMENTS}
    rows = []
    for route, cities in K.ROUTES.items():
        km = 0.0
        for i in range(1, len(cities)):
            a, b = cities[i - 1], cities[i]
            dist, lim = seg[frozenset((a, b))]
            s_km, km = km, km + dist
            (sla, slo), (ela, elo) = K.CITIES[a], K.CITIES[b]
            nums = ", ".join(_dbl(x) for x in (s_km, km, sla, slo, ela, elo))
            rows.append(f"('{route}', {i}, {nums}, '{b}', {lim})")
    return (
        "legs(route_name, seq, s_km, e_km, s_lat, s_lon, e_lat, e_lon, e_city, speed_limit_kmph) AS (VALUES "
        + ", ".join(rows)
        + ")"
    )


def _eta_values():
    seg = {frozenset((a, b)): (dist, lim) for a, b, dist, lim in K.ROAD_SEGMENTS}
    rows = []
    for route, cities in K.ROUTES.items():
        legs = [seg[frozenset((cities[i - 1], cities[i]))] for i in range(1, len(cities))]
        total = 0.0
        for dist, _ in legs:
            total += dist
        avg = sum(lim for _, lim in legs) / len(legs)
        rows.append(f"('{route}', {_dbl(total)}, {_dbl(avg)})")
    return "eta(route_name, total_km, avg_limit) AS (VALUES " + ", ".join(rows) + ")"


LIVE_BOUND = 1800
LIVE_PAIRS = f"""pairs AS (
  SELECT g.vehicle_id, g.trip_id, g.event_timestamp, g.lat, g.lon, g.speed_kmph, g.heading, g.route_name,
         s.event_timestamp AS reading_timestamp,
         s.engine_temp_c, s.fuel_level_litres, s.cargo_temp_c, s.anomaly_flag, s.is_critical_anomaly
  FROM gps_silver g JOIN sensor_silver s
    ON g.vehicle_id = s.vehicle_id AND g.trip_id = s.trip_id
   AND g.event_timestamp BETWEEN s.event_timestamp - INTERVAL {LIVE_BOUND} SECOND
                             AND s.event_timestamp + INTERVAL {LIVE_BOUND} SECOND)"""

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

BATCH_SQL = {
    "shipment_invoice_silver": with_(MANIFESTS, INVOICES, JOINED, SHIP_SILVER) + "SELECT * FROM ship",
    "daily_revenue": with_(MANIFESTS, INVOICES, JOINED, SHIP_SILVER)
    + """SELECT shipment_date, route_name, priority,
       round(sum(amount_inr), 2) AS revenue
FROM ship WHERE is_invoiced GROUP BY shipment_date, route_name, priority""",
    "shipment_expectations_report": with_(MANIFESTS, INVOICES, JOINED) + _report(SHIP_RULES, "joined"),
    "shipment_quarantine": with_(MANIFESTS, INVOICES, JOINED)
    + f"SELECT *, {_failed_list([(n, p) for n, _, p in SHIP_RULES])} AS failed_rules FROM joined WHERE NOT ({SHIP_OK})",
    "maintenance_silver": with_(MAINT, MAINT_SILVER) + "SELECT * FROM maint_silver",
    "gps_silver": with_(GPS, GPS_SILVER) + "SELECT * FROM gps_silver",
    "gps_expectations_report": with_(GPS) + _report(GPS_RULES, "gps"),
    "sensor_silver": with_(SENSOR, SENSOR_PREP, SENSOR_SILVER) + "SELECT * FROM sensor_silver",
    "sensor_quarantine": with_(SENSOR, SENSOR_PREP)
    + f"SELECT *, {_failed_list(SENSOR_RULES)} AS failed_rules FROM sensor_prep WHERE NOT ({SENSOR_OK})",
    "delivery_silver": with_(DELIVERY, DELIVERY_SILVER) + "SELECT * FROM delivery_silver",
    "scd2_all": f"""SELECT {EVENT_COLS}, ts AS __START_AT, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS __END_AT
FROM events WHERE ts IS NOT NULL""",
    "scd2_tracked": with_(EVENTS_TRACKED) + "SELECT * FROM ev_hist",
    "scd2_current": with_(EVENTS_TRACKED) + "SELECT * FROM ev_hist WHERE __END_AT IS NULL",
    "scd1_latest": f"SELECT {EVENT_COLS} FROM events WHERE ts IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1",
    "master_scd2": with_(MASTER, MASTER_ALL_HIST) + "SELECT * FROM master_hist",
    "master_scd2_tracked": with_(MASTER, MASTER_TRACKED_HIST) + "SELECT * FROM master_thist",
    "vehicle_scorecard": with_(MAINT, MAINT_SILVER, MASTER, MASTER_ALL_HIST)
    + """, costs AS (
  SELECT vehicle_id, round(sum(cost_inr), 2) AS total_maintenance_cost_inr,
         count(log_id) AS maintenance_event_count
  FROM maint_silver GROUP BY vehicle_id)
SELECT c.vehicle_id, m.driver_name, m.vehicle_type, m.home_route, m.is_active,
       c.total_maintenance_cost_inr, c.maintenance_event_count
FROM costs c LEFT JOIN (SELECT * FROM master_hist WHERE __END_AT IS NULL) m ON c.vehicle_id = m.vehicle_id""",
    "asof_dimension_join": """WITH ev_prev AS (
  SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS prev_t,
         row_number() OVER (PARTITION BY user_id ORDER BY ts) AS rn
  FROM events WHERE event_type <> 'purchase' AND ts IS NOT NULL),
hist AS (SELECT user_id, ts AS __START_AT, event_type FROM ev_prev WHERE rn = 1 OR prev_t IS DISTINCT FROM event_type),
facts AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase')
SELECT f.event_id, f.user_id, f.ts, f.value, h.event_type, h.__START_AT
FROM facts f ASOF LEFT JOIN hist h ON f.user_id = h.user_id AND f.ts >= h.__START_AT""",
    "active_alerts": with_(SENSOR, SENSOR_PREP, SENSOR_SILVER)
    + """SELECT vehicle_id, trip_id, event_timestamp, anomaly_flag, engine_temp_c, fuel_level_litres, cargo_temp_c
FROM sensor_silver WHERE is_critical_anomaly""",
    "delivery_performance": with_(DELIVERY, DELIVERY_SILVER)
    + """SELECT date_trunc('hour', event_timestamp) AS window_start,
       date_trunc('hour', event_timestamp) + INTERVAL 1 HOUR AS window_end, status, count(*) AS event_count
FROM delivery_silver WHERE event_timestamp IS NOT NULL AND status IS NOT NULL GROUP BY 1, 2, 3""",
    "fuel_cost_efficiency": with_(SENSOR, SENSOR_PREP, SENSOR_SILVER, GPS, GPS_SILVER)
    + """SELECT s.trip_id, max(s.fuel_level_litres) AS fuel_start_litres, min(s.fuel_level_litres) AS fuel_end_litres,
       max(g.distance_traveled_km) AS max_distance_km, min(g.distance_traveled_km) AS min_distance_km,
       max(s.fuel_level_litres) - min(s.fuel_level_litres) AS estimated_fuel_consumed_litres,
       max(g.distance_traveled_km) - min(g.distance_traveled_km) AS estimated_distance_km
FROM sensor_silver s JOIN gps_silver g ON s.vehicle_id = g.vehicle_id AND s.trip_id = g.trip_id
GROUP BY s.trip_id""",
    "fuel_by_day_route": with_(SENSOR, SENSOR_PREP, SENSOR_SILVER, GPS, GPS_SILVER)
    + """, s AS (
  SELECT vehicle_id, trip_id, CAST(event_timestamp AS DATE) AS event_date,
         max(fuel_level_litres) AS f_max, min(fuel_level_litres) AS f_min
  FROM sensor_silver WHERE vehicle_id IS NOT NULL AND trip_id IS NOT NULL GROUP BY 1, 2, 3),
g AS (
  SELECT vehicle_id, trip_id, CAST(event_timestamp AS DATE) AS event_date, route_name,
         max(distance_traveled_km) AS d_max, min(distance_traveled_km) AS d_min
  FROM gps_silver WHERE vehicle_id IS NOT NULL AND trip_id IS NOT NULL GROUP BY 1, 2, 3, 4)
SELECT s.event_date, g.route_name, round(sum(f_max - f_min), 6) AS fuel_consumed_litres,
       round(sum(d_max - d_min), 6) AS distance_km, count(*) AS trip_days
FROM s JOIN g ON s.vehicle_id = g.vehicle_id AND s.trip_id = g.trip_id AND s.event_date = g.event_date
GROUP BY s.event_date, g.route_name""",
    "live_fleet_status": with_(GPS, GPS_SILVER, SENSOR, SENSOR_PREP, SENSOR_SILVER, LIVE_PAIRS)
    + """SELECT vehicle_id, trip_id, event_timestamp, lat, lon, speed_kmph, heading, route_name,
       engine_temp_c, fuel_level_litres, cargo_temp_c, anomaly_flag, is_critical_anomaly FROM pairs""",
    "nearest_reading": with_(GPS, GPS_SILVER, SENSOR, SENSOR_PREP, SENSOR_SILVER, LIVE_PAIRS)
    + """SELECT * FROM pairs
QUALIFY row_number() OVER (PARTITION BY vehicle_id, trip_id, event_timestamp
                           ORDER BY abs(epoch_us(event_timestamp) - epoch_us(reading_timestamp)), reading_timestamp) = 1""",
    "latest_events_topk": "SELECT * FROM events ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST LIMIT 10",
    "master_masked": with_(MASTER)
    + """SELECT snapshot_date, vehicle_id, license_plate, vehicle_type, driver_id, driver_name,
       sha256('registered-query:' || driver_phone || ':registered-query') AS driver_phone,
       sha256('registered-query:' || driver_license_no || ':registered-query') AS driver_license_no,
       home_route, is_active, last_change_type
FROM master""",
    "master_redacted": with_(MASTER)
    + """SELECT snapshot_date, vehicle_id, license_plate, vehicle_type, driver_id, driver_name,
       repeat('*', length(driver_phone) - 2) || right(driver_phone, 2) AS driver_phone,
       repeat('*', length(driver_license_no) - 2) || right(driver_license_no, 2) AS driver_license_no,
       home_route, is_active, last_change_type
FROM master""",
    "asof_gaps": """WITH hist AS (
  SELECT user_id, ts AS s, ts + INTERVAL 6 HOUR AS e, max(value) + 1 AS level
  FROM events WHERE event_type = 'click' AND ts IS NOT NULL GROUP BY ALL),
facts AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase')
SELECT f.event_id, f.user_id, f.ts, CASE WHEN f.ts < h.e THEN h.level END AS level, CASE WHEN f.ts < h.e THEN h.s END AS __START_AT
FROM facts f ASOF LEFT JOIN hist h ON f.user_id = h.user_id AND f.ts >= h.s""",
    "gps_dedup_batch": with_(GPS.replace("FROM events WHERE", "FROM (SELECT * FROM events UNION ALL SELECT * REPLACE (value + 1 AS value) FROM events) WHERE"))
    + """SELECT * FROM gps QUALIFY row_number() OVER (PARTITION BY trip_id, event_timestamp
  ORDER BY vehicle_id DESC, driver_id DESC, timestamp DESC, lat DESC, lon DESC, speed_kmph DESC, heading DESC) = 1""",
    "vehicle_scorecard_asof": with_(MAINT, MAINT_SILVER, MASTER, MASTER_ALL_HIST)
    + """SELECT l.vehicle_id, m.driver_name, m.vehicle_type, m.home_route, round(sum(cost_inr), 2) AS total_maintenance_cost_inr,
       count(log_id) AS maintenance_event_count
FROM maint_silver l LEFT JOIN master_hist m ON l.vehicle_id = m.vehicle_id AND l.service_date >= m.__START_AT
 AND (m.__END_AT IS NULL OR l.service_date < m.__END_AT)
GROUP BY ALL""",
    "gps_row_security": with_(GPS, GPS_SILVER)
    + "SELECT * FROM gps_silver WHERE route_name IN ('ROUTE_MUM_PUNE', 'ROUTE_PUNE_NASHIK_AURANGABAD')",
    "events_schema_evolution": """SELECT event_id, ts, user_id, event_type, 'props,value' AS rescued_keys,
       value AS rescued_value, props AS rescued_props FROM events""",
    "table_counts": "\nUNION ALL\n".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES),
    "ping_step_distance": with_(GPS, GPS_SILVER)
    + """, p AS (
  SELECT trip_id, event_timestamp, lat, lon,
         lag(lat) OVER (PARTITION BY trip_id ORDER BY event_timestamp) AS plat,
         lag(lon) OVER (PARTITION BY trip_id ORDER BY event_timestamp) AS plon
  FROM gps_silver)
SELECT trip_id, event_timestamp, round("""
    + HAVERSINE.format(la1="plat", lo1="plon", la2="lat", lo2="lon")
    + """, 6) AS step_km FROM p""",
    "trip_distance": with_(GPS, GPS_SILVER)
    + """, p AS (
  SELECT trip_id, event_timestamp, lat, lon,
         lag(lat) OVER (PARTITION BY trip_id ORDER BY event_timestamp) AS plat,
         lag(lon) OVER (PARTITION BY trip_id ORDER BY event_timestamp) AS plon
  FROM gps_silver)
SELECT trip_id, count(*) AS pings, round(coalesce(sum("""
    + HAVERSINE.format(la1="plat", lo1="plon", la2="lat", lo2="lon")
    + """), 0.0), 6) AS total_km FROM p GROUP BY trip_id""",
    "route_position": with_(GPS, GPS_SILVER, _legs_values())
    + """, tot AS (SELECT route_name, max(e_km) AS total_km FROM legs GROUP BY route_name),
pt AS (
  SELECT g.trip_id, g.event_timestamp, g.route_name, g.distance_traveled_km, t.total_km,
         greatest(0.0, least(g.distance_traveled_km, t.total_km)) AS d
  FROM gps_silver g LEFT JOIN tot t ON g.route_name = t.route_name),
hit AS (
  SELECT pt.*, l.seq, l.s_km, l.e_km, l.s_lat, l.s_lon, l.e_lat, l.e_lon, l.e_city, l.speed_limit_kmph
  FROM pt LEFT JOIN legs l ON pt.route_name = l.route_name AND l.s_km <= pt.d AND pt.d <= l.e_km
  QUALIFY row_number() OVER (PARTITION BY pt.trip_id, pt.event_timestamp ORDER BY l.seq) = 1),
fr AS (SELECT *, CASE WHEN e_km - s_km = 0 THEN 0.0 ELSE (d - s_km) / (e_km - s_km) END AS frac FROM hit)
SELECT trip_id, event_timestamp, route_name, distance_traveled_km,
       round(s_lat + (e_lat - s_lat) * frac, 6) AS pos_lat, round(s_lon + (e_lon - s_lon) * frac, 6) AS pos_lon,
       speed_limit_kmph, round(d, 2) AS distance_km, round(total_km, 2) AS total_km, e_city AS nearest_segment_end_city
FROM fr""",
    "route_eta": with_(GPS, GPS_SILVER, _eta_values())
    + """SELECT t.trip_id, t.route_name, e.total_km, round(e.total_km / (e.avg_limit * 0.75), 2) AS expected_hours
FROM (SELECT DISTINCT trip_id, route_name FROM gps_silver) t LEFT JOIN eta e ON t.route_name = e.route_name""",
}


BATCH_SQL["event_time_quarantine"] = with_(GPS) + """SELECT event_type, trip_id, vehicle_id, driver_id, 'at ' || timestamp AS timestamp,
       lat, lon, speed_kmph, heading, distance_traveled_km, route_name, 'valid_event_time' AS failed_rules
FROM gps WHERE lat < 8"""
BATCH_SQL["vehicle_scorecard_history"] = BATCH_SQL["vehicle_scorecard"]


def oracle_sql() -> dict[str, str]:
    from fleetspark.plans.stream_catalog import STREAM_SQL

    return {**BATCH_SQL, **STREAM_SQL}
