"""Road-network operators (L1-L5) as joins and column expressions.

The network (5 cities, 5 segments, 5 routes) is a fixed lookup table whose
size does not grow with the data, so it is broadcast; the data side (pings,
trips) is never shuffled for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetspark import constants as K
from fleetspark.functions.geo import haversine_km, interpolate
from fleetspark.operators.sequence import with_neighbor


def _literal_table(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    """A constant table as a literal array of structs, expanded in the JVM (no
    Python-side data transfer); the optimizer folds it into a local relation."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, r)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def cities(spark: SparkSession) -> DataFrame:
    return _literal_table(spark, ["city", "lat", "lon"], [(c, lat, lon) for c, (lat, lon) in K.CITIES.items()])


def segments(spark: SparkSession) -> DataFrame:
    return _literal_table(
        spark, ["from_city", "to_city", "distance_km", "speed_limit_kmph"],
        [(a, b, float(d), int(lim)) for a, b, d, lim in K.ROAD_SEGMENTS],
    )


def routes(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(
        F.inline(F.array(*[
            F.struct(F.lit(r).alias("route_name"), F.array(*[F.lit(c) for c in cs]).alias("cities"))
            for r, cs in K.ROUTES.items()
        ]))
    )


def route_waypoints(spark: SparkSession) -> DataFrame:
    """L2: ordered waypoints of every route with cumulative km and the speed
    limit of the segment that ends there (the start takes the first segment's).

    Segments are found by the unordered city pair; the end city is the
    route's next city."""
    hops = (
        routes(spark)
        .select("route_name", F.posexplode("cities").alias("idx", "city"))
        .withColumn("prev_city", F.lag("city").over(Window.partitionBy("route_name").orderBy("idx")))
    )
    seg = segments(spark).select(
        F.least("from_city", "to_city").alias("a"), F.greatest("from_city", "to_city").alias("b"),
        "distance_km", "speed_limit_kmph",
    )
    legs = hops.join(
        F.broadcast(seg),
        (F.least("city", "prev_city") == F.col("a")) & (F.greatest("city", "prev_city") == F.col("b")),
        "left",
    )
    w = Window.partitionBy("route_name").orderBy("idx")
    first_limit = F.first(F.when(F.col("idx") == 1, F.col("speed_limit_kmph")), ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    out = legs.withColumn("cumulative_km", F.sum(F.coalesce("distance_km", F.lit(0.0))).over(w)).withColumn(
        "speed_limit_kmph", F.when(F.col("idx") == 0, first_limit).otherwise(F.col("speed_limit_kmph"))
    )
    c = cities(spark)
    return out.join(F.broadcast(c), "city", "left").select(
        "route_name", F.col("idx").alias("seq"), "city", "lat", "lon", "cumulative_km", "speed_limit_kmph"
    )


def route_totals(spark: SparkSession) -> DataFrame:
    """L3: total km per route."""
    return route_waypoints(spark).groupBy("route_name").agg(F.max("cumulative_km").alias("total_km"))


def route_eta(spark: SparkSession) -> DataFrame:
    """Expected hours = total km / (0.75 x mean limit of the segments),
    rounded to 2 places."""
    wp = route_waypoints(spark)
    return wp.groupBy("route_name").agg(
        F.max("cumulative_km").alias("total_km"),
        F.avg(F.when(F.col("seq") > 0, F.col("speed_limit_kmph"))).alias("_avg_limit"),
    ).select(
        "route_name", "total_km",
        F.round(F.col("total_km") / (F.col("_avg_limit") * F.lit(K.SPEED_FACTOR)), 2).alias("expected_hours"),
    )


def route_legs(spark: SparkSession) -> DataFrame:
    """One row per route: its total and the array of legs (start/end km and
    coordinates, end city, limit) in route order -- a few bytes per route."""
    wp = route_waypoints(spark)
    w = Window.partitionBy("route_name").orderBy("seq")
    legs = (
        wp.withColumn("s_km", F.lag("cumulative_km").over(w))
        .withColumn("s_lat", F.lag("lat").over(w))
        .withColumn("s_lon", F.lag("lon").over(w))
        .where(F.col("seq") > 0)
    )
    leg = F.struct(
        F.col("seq"), F.col("s_km"), F.col("cumulative_km").alias("e_km"), "s_lat", "s_lon",
        F.col("lat").alias("e_lat"), F.col("lon").alias("e_lon"), F.col("city").alias("e_city"), "speed_limit_kmph",
    )
    return legs.groupBy("route_name").agg(
        F.array_sort(F.collect_list(leg)).alias("legs"), F.max("cumulative_km").alias("total_km")
    )


def position_on_route(df: DataFrame, route_col: str, distance_col: str) -> DataFrame:
    """L4: for every row, the point ``distance_col`` km along its route:
    distance clamped to [0, total], the *first* leg containing it (ends
    inclusive), linear interpolation; lat/lon rounded to 6 places and
    distances to 2. Unknown route -> NULLs.

    Adds: pos_lat, pos_lon, speed_limit_kmph, distance_km, total_km,
    nearest_segment_end_city."""
    spark = df.sparkSession
    legs = route_legs(spark).withColumnRenamed("route_name", "_route")
    j = df.join(F.broadcast(legs), F.col(route_col) == F.col("_route"), "left")
    d = F.greatest(F.lit(0.0), F.least(F.col(distance_col), F.col("total_km")))
    j = j.withColumn("_d", d)
    hit = F.try_element_at(F.filter("legs", lambda x: (x["s_km"] <= F.col("_d")) & (F.col("_d") <= x["e_km"])), F.lit(1))
    j = j.withColumn("_leg", hit)
    seg_len = F.col("_leg.e_km") - F.col("_leg.s_km")
    frac = F.when(seg_len == 0, F.lit(0.0)).otherwise((F.col("_d") - F.col("_leg.s_km")) / seg_len)
    return j.select(
        *[F.col(c) for c in df.columns],
        F.round(interpolate(F.col("_leg.s_lat"), F.col("_leg.e_lat"), frac), 6).alias("pos_lat"),
        F.round(interpolate(F.col("_leg.s_lon"), F.col("_leg.e_lon"), frac), 6).alias("pos_lon"),
        F.col("_leg.speed_limit_kmph").alias("speed_limit_kmph"),
        F.round(F.col("_d"), 2).alias("distance_km"),
        F.round(F.col("total_km"), 2).alias("total_km"),
        F.col("_leg.e_city").alias("nearest_segment_end_city"),
    )


#: Pings of one trip and day that a task may hold before they are split by time.
SPLIT_ROWS = 1_000_000


def with_step_distance(
    pings: DataFrame, trip_cols: list[str], time_col: str, lat: str = "lat", lon: str = "lon", split_rows: int | None = SPLIT_ROWS
) -> DataFrame:
    """L1: km from the previous ping of the same trip (NULL for the first),
    via the chunked previous-row helper; a trip is split by day, and a day by the number of its pings."""
    position = F.struct(F.col(lat).alias("la"), F.col(lon).alias("lo"))
    timed = pings.schema[time_col].dataType.typeName() != "string"
    prev = with_neighbor(pings, trip_cols, [time_col], position, "_prev", split_rows=split_rows if timed else None)
    return prev.withColumn(
        "step_km", haversine_km(F.col("_prev.la"), F.col("_prev.lo"), F.col(lat), F.col(lon))
    ).drop("_prev")


def trip_distance(pings: DataFrame, trip_cols: list[str], time_col: str, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """L1: pings and total km per trip."""
    steps = with_step_distance(pings, trip_cols, time_col, lat, lon)
    return steps.groupBy(*trip_cols).agg(
        F.count(F.lit(1)).alias("pings"), F.coalesce(F.sum("step_km"), F.lit(0.0)).alias("total_km")
    )


def hours_for_route(df: DataFrame, route_col: str) -> DataFrame:
    """L5 attached to rows (e.g. trips) by route, broadcast lookup."""
    eta = route_eta(df.sparkSession).withColumnRenamed("route_name", "_route")
    return df.join(F.broadcast(eta), F.col(route_col) == F.col("_route"), "left").drop("_route")
