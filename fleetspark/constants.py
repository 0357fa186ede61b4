"""Domain constants.

FIXED VALUES: the bounds, the delivery state order and the road network below
must equal the source system's values for results to match. They are stated
plainly, in their natural order.
"""

from __future__ import annotations

# --- fixed values: data-quality bounds (inclusive) ------------------------
LAT_RANGE = (8.0, 37.0)
LON_RANGE = (68.0, 97.0)
SPEED_RANGE = (0.0, 150.0)
ENGINE_TEMP_RANGE = (-20.0, 150.0)
FUEL_RANGE = (0.0, 200.0)
CARGO_TEMP_RANGE = (-30.0, 50.0)

# --- fixed values: delivery state -> order --------------------------------
DELIVERY_STATE_ORDER = {
    "created": 0,
    "picked_up": 1,
    "in_transit": 2,
    "out_for_delivery": 3,
    "delivered": 4,
}

# --- fixed values: anomaly kinds emitted by the sensors -------------------

# --- fixed values: watermark delays and join bound ------------------------
GPS_WATERMARK = "2 minutes"
SENSOR_WATERMARK = "2 minutes"
DELIVERY_WATERMARK = "10 minutes"
DELIVERY_WINDOW = "1 hour"
LIVE_JOIN_BOUND_SECONDS = 30

# --- fixed values: road network (WGS84) -----------------------------------
EARTH_RADIUS_KM = 6371.0

# city -> (lat, lon)
CITIES = {
    "Mumbai": (19.0760, 72.8777),
    "Pune": (18.5204, 73.8567),
    "Nashik": (19.9975, 73.7898),
    "Aurangabad": (19.8762, 75.3433),
    "Nagpur": (21.1458, 79.0882),
}

# (from_city, to_city, distance_km, truck_speed_limit_kmph)
ROAD_SEGMENTS = [
    ("Mumbai", "Pune", 94.5, 80),
    ("Mumbai", "Nashik", 150.0, 80),
    ("Nashik", "Aurangabad", 180.0, 70),
    ("Pune", "Nashik", 210.0, 70),
    ("Pune", "Aurangabad", 235.0, 70),
]

# route -> ordered cities
ROUTES = {
    "ROUTE_MUM_PUNE": ["Mumbai", "Pune"],
    "ROUTE_MUM_NASHIK": ["Mumbai", "Nashik"],
    "ROUTE_NASHIK_AURANGABAD": ["Nashik", "Aurangabad"],
    "ROUTE_PUNE_NASHIK_AURANGABAD": ["Pune", "Nashik", "Aurangabad"],
    "ROUTE_MUM_NASHIK_AURANGABAD": ["Mumbai", "Nashik", "Aurangabad"],
}

# share of the posted limit a loaded truck averages (traffic, stops)
SPEED_FACTOR = 0.75
