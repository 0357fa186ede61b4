"""A key holding most of the rows must not land in one task."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fleetspark.operators import joins, scd
from fleetspark.operators.sequence import default_chunk, partition_by_key_and_chunk


@pytest.fixture
def no_coalesce(spark):
    """AQE would merge this small test data into one partition; measure the
    distribution the plan asks for."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, old)


def _hot_events(spark, n=4000, days=20):
    base = dt.datetime(2026, 1, 1)
    rows = [(0 if i % 10 else i, base + dt.timedelta(minutes=7 * i), "ab"[i % 3 == 0]) for i in range(n)]
    return spark.createDataFrame(rows, "user_id long, ts timestamp_ntz, kind string")


def test_hot_key_spreads_over_partitions(spark, no_coalesce):
    df = _hot_events(spark)
    parted = partition_by_key_and_chunk(df, ["user_id"], default_chunk(df, "ts"))
    hot = parted.where(F.col("user_id") == 0).select(F.spark_partition_id().alias("p")).distinct().count()
    assert hot > 1


def test_scd2_on_hot_key_matches_plain_window(spark):
    from pyspark.sql import Window

    df = _hot_events(spark)
    got = scd.scd2(df, ["user_id"], "ts", track=["kind"])
    w = Window.partitionBy("user_id").orderBy("ts")
    chg = df.withColumn("p", F.lag("kind").over(w)).where(F.col("p").isNull() | (F.col("p") != F.col("kind")))
    want = chg.withColumn("e", F.lead("ts").over(w)).select("user_id", "ts", "e")
    assert sorted(got.select("user_id", "ts", "__END_AT").collect()) == sorted(want.collect())


def test_interval_join_buckets_split_hot_trip(spark, no_coalesce):
    base = dt.datetime(2026, 1, 1)
    g = spark.createDataFrame([("V", "T", base + dt.timedelta(seconds=10 * i)) for i in range(3000)], "vehicle_id string, trip_id string, t timestamp")
    s = spark.createDataFrame([("V", "T", base + dt.timedelta(seconds=10 * i + 3), i) for i in range(3000)], "vehicle_id string, trip_id string, t timestamp, r int")
    out = joins.interval_join(g, s, ["vehicle_id", "trip_id"], "t", "t", 30, [F.col("g.t"), F.col("s.r")])
    want = sum(1 for i in range(3000) for j in range(max(0, i - 4), min(3000, i + 5)) if abs(10 * i - (10 * j + 3)) <= 30)
    assert out.count() == want
    spread = out.select(F.spark_partition_id().alias("p")).distinct().count()
    assert spread > 1


def _one_trip(spark, n):
    """One trip whose pings all lie in two hours of one day, most of them in a few minutes, and some other trips."""
    base = dt.datetime(2026, 1, 1, 10)
    hot = [("T", base + dt.timedelta(milliseconds=100 * i if i < n - 50 else 100 * n + 60_000 * (i - n + 50)), 18 + i % 7 / 10, 73.0) for i in range(n)]
    rest = [(f"T{i % 5}", base + dt.timedelta(hours=i), 18 + i % 3 / 10, 73.0) for i in range(40)]
    return spark.createDataFrame(hot + rest + [(None, base, 1.0, 1.0), ("T", None, 2.0, 2.0)], "trip_id string, t timestamp, lat double, lon double")


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_one_trip_in_one_day_spreads_and_stays_exact(spark, no_coalesce, kind):
    from fleetspark.operators import routes

    pings = _one_trip(spark, 3000).withColumn("t", F.col("t").cast(kind))
    parted = partition_by_key_and_chunk(pings, ["trip_id"], default_chunk(pings, "t"), "t", split_rows=200)
    hot = parted.where("trip_id = 'T' and t is not null")
    assert hot.select("_chunk").distinct().count() > 8
    assert hot.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    whole = routes.with_step_distance(pings, ["trip_id"], "t", split_rows=None)
    split = routes.with_step_distance(pings, ["trip_id"], "t", split_rows=200)
    assert sorted(map(repr, split.collect())) == sorted(map(repr, whole.collect()))


def test_nearest_matches_all_pairs_for_any_split(spark):
    import random

    rng = random.Random(5)
    base = dt.datetime(2026, 1, 1, 23, 50)
    at = lambda: base + dt.timedelta(seconds=rng.randrange(1200))
    left = [(rng.choice("AB"), at(), i) for i in range(150)] + [(None, base, 900), ("A", None, 901)]
    right = [(rng.choice("AB"), t, i) for i, t in enumerate({at() for _ in range(80)})] + [(None, base, 900)]
    l = spark.createDataFrame(left, "k string, t timestamp, i int")
    r = spark.createDataFrame(right, "k string, t timestamp, r int")
    want = []
    for k, t, i in left:
        near = [(abs((t - u).total_seconds()), u, j) for q, u, j in right if k and t and q == k and abs((t - u).total_seconds()) <= 20]
        want += [(i, min(near)[2])] if near else []
    for chunk in (1, 30, 600):
        got = joins.nearest_within(l, r, ["k"], "t", "t", 20, ["i"], ["r"], chunk_seconds=chunk)
        assert sorted((x["i"], x["r"]) for x in got.collect()) == sorted(want)


def test_carry_back_matches_plain_window(spark):
    from pyspark.sql import Window

    from fleetspark.operators.sequence import with_neighbor

    df = spark.range(400).select((F.col("id") % 3).alias("k"), "id", F.when(F.col("id") % 7 == 0, F.col("id")).alias("v"))
    w = Window.partitionBy("k").orderBy("id").rowsBetween(1, Window.unboundedFollowing)
    want = df.withColumn("n", F.first("v", ignorenulls=True).over(w)).collect()
    got = with_neighbor(df, ["k"], ["id"], F.col("v"), "n", "next", F.floor(F.col("id") / 40), ignore_nulls=True).select("k", "id", "v", "n").collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_scd2_with_null_values_over_many_chunks(spark):
    """Values that are NULL, stay equal over whole chunks or return are told apart as by a plain window."""
    from pyspark.sql import Window

    rows = [(k, i, None if (i // 37 + k) % 3 == 0 else "ab"[(i // 61) % 2]) for k in range(4) for i in range(0, 600, 1 + k)]
    df = spark.createDataFrame(rows, "k int, s long, v string")
    w = Window.partitionBy("k").orderBy("s")
    prev = df.withColumn("p", F.lag(F.struct("v")).over(w))
    opened = prev.where(F.col("p").isNull() | ~F.struct("v").eqNullSafe(F.col("p"))).withColumn("e", F.lead("s").over(w))
    want = opened.select("k", "s", "v", F.col("s").alias("__START_AT"), F.col("e").alias("__END_AT"))
    for width in (7, 50, 1000):
        got = scd.scd2(df, ["k"], "s", track=["v"], chunk=F.floor(F.col("s") / width))
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def _one_day(spark, n):
    """A vehicle with most snapshots, all on one day or in one month, by string, date and time; some other vehicles."""
    base = dt.datetime(2026, 1, 1)
    rows = []
    for i in range(n):
        at = base + dt.timedelta(seconds=20 * (i // 2))
        rows.append((0 if i % 10 else i, at, at.isoformat(), (base + dt.timedelta(days=i % 28)).date(), "abc"[(i // 7) % 3]))
    rows.append((0, None, None, None, "a"))
    return spark.createDataFrame(rows, "k long, t timestamp_ntz, s string, d date, v string")


@pytest.mark.parametrize("column", ["t", "s", "d"])
def test_hot_chunk_is_split_for_any_order(spark, no_coalesce, column):
    df = _one_day(spark, 4000)
    parted = partition_by_key_and_chunk(df, ["k"], default_chunk(df, column), [column, "v"], split_rows=200)
    hot = parted.where("k = 0")
    parts = hot.groupBy("_chunk").agg(F.count("*").alias("n"), F.min(column).alias("a"), F.max(column).alias("b")).where("a is not null").orderBy("a").collect()
    assert len(parts) > 8 and max(r.n for r in parts) < 1000
    assert all(x.b < y.a for x, y in zip(parts, parts[1:]))  # parts follow the order and ties stay together
    assert [r["_chunk"].p for r in parts] == sorted(r["_chunk"].p for r in parts)


@pytest.mark.parametrize("column", ["t", "s"])
def test_split_history_and_lookup_equal_unsplit_ones(spark, column):
    df = _one_day(spark, 1500)
    whole = scd.scd2(df, ["k"], column, track=["v"], split_rows=None)
    split = scd.scd2(df, ["k"], column, track=["v"], split_rows=50)
    assert sorted(map(tuple, split.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
    facts = df.select("k", F.col(column).alias("at"), F.col("v").alias("w"))
    look = lambda n: sorted(map(tuple, scd.asof_join(facts, whole, "k", "k", "at", ["v"], split_rows=n).collect()), key=repr)
    assert look(50) == look(None)
