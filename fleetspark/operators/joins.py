"""Joins (C1, C3-C5).

Skew rule: one join key may carry a third of all rows. Every batch join here
either lets AQE split the hot partition (inner joins; left joins on the left
side) or is rewritten so that it can:

* C1 left outer join = inner join  UNION ALL  left-anti join against the
  *distinct* right keys. A plain left outer join cannot split a hot key on
  the right (the preserved side would be duplicated); the inner join can be
  split by AQE, and the anti join only sees one row per right key (the
  distinct is a hash aggregate with a map-side partial stage, so the hot key
  collapses before the shuffle).
* C4 interval join adds a time bucket to the equi-keys (R3), so one hot
  (vehicle, trip) spreads over as many tasks as it has buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetspark.operators.sequence import CHUNK, KEY, partition_by_key_and_chunk


def _prefixed(alias: str, cols: Sequence[str]) -> list[Column]:
    return [F.col(f"{alias}.{c}") for c in cols]


def left_join_keep_all(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    left_cols: Sequence[str],
    right_cols: Sequence[str],
) -> DataFrame:
    """Every left row, each matching right row attached (fan-out), NULL
    right columns when there is none. NULL keys never match.

    Output columns: ``left_cols`` then ``right_cols`` (names must not clash).
    On a streaming left side this is the native stream-static left join (the
    static side is re-read every micro-batch); in batch it is the skew-safe
    inner + anti decomposition described in the module doc.
    """
    l, r = left.alias("l"), right.alias("r")
    out = _prefixed("l", left_cols) + _prefixed("r", right_cols)
    cond = F.col(f"l.{left_key}") == F.col(f"r.{right_key}")
    if left.isStreaming:
        return l.join(r, cond, "left").select(*out)
    nulls = [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in right_cols]
    # Non-null keys go through both joins with one identical left subtree, so
    # its scan and shuffle are computed once and reused; NULL keys never match
    # and skip the joins (an IS NULL scan: row groups without NULLs are skipped).
    keyed = left.where(F.col(left_key).isNotNull()).alias("l")
    matched = keyed.join(r, cond, "inner").select(*out)
    right_keys = right.select(F.col(right_key).alias("_rk")).where(F.col("_rk").isNotNull()).distinct()
    unmatched = keyed.join(right_keys, F.col(f"l.{left_key}") == F.col("_rk"), "left_anti").select(
        *_prefixed("l", left_cols), *nulls
    )
    null_keys = left.where(F.col(left_key).isNull()).select(*[F.col(c) for c in left_cols], *nulls)
    return matched.unionByName(unmatched).unionByName(null_keys)


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    bound_seconds: int,
    select: Sequence[Column],
    left_alias: str = "g",
    right_alias: str = "s",
) -> DataFrame:
    """C4: inner join on ``keys`` (NULL never matches) and
    ``left.ts BETWEEN right.ts - bound AND right.ts + bound`` (both ends
    inclusive).

    R3: buckets of width 2*bound on the left time; each right row lists the
    (at most two) buckets its range touches, so a pair meets in exactly one
    bucket. The bucket is an extra equi-key, so a hot (vehicle, trip) spreads
    over tasks -- in batch, and on streams over state-store partitions (the
    symmetric hash join keeps its state per key); state is still evicted by the
    two watermarks the caller set plus the time bound in the condition.
    """
    if bound_seconds <= 0:
        raise ValueError("bound_seconds must be positive")
    lt, rt = F.col(f"{left_alias}.{left_ts}"), F.col(f"{right_alias}.{right_ts}")
    bound = F.make_dt_interval(secs=F.lit(bound_seconds))
    width_us = 2 * bound_seconds * 1_000_000
    bound_us = bound_seconds * 1_000_000

    def bucket(us: Column) -> Column:
        return F.floor(us / F.lit(width_us))

    g = left.withColumn("_tb", bucket(F.unix_micros(F.col(left_ts).cast("timestamp")))).alias(left_alias)
    r_us = F.unix_micros(F.col(right_ts).cast("timestamp"))
    s = right.withColumn(
        "_tb", F.explode(F.sequence(bucket(r_us - F.lit(bound_us)), bucket(r_us + F.lit(bound_us))))
    ).alias(right_alias)
    cond = F.col(f"{left_alias}._tb") == F.col(f"{right_alias}._tb")
    for k in keys:
        cond = cond & (F.col(f"{left_alias}.{k}") == F.col(f"{right_alias}.{k}"))
    # The range predicate stays in the condition: it decides the match, and on
    # streams it is what lets both watermarks evict join state.
    cond = cond & lt.between(rt - bound, rt + bound)
    return g.join(s, cond, "inner").select(*select)


def nearest_within(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    bound_seconds: int,
    left_cols: Sequence[str],
    right_cols: Sequence[str],
    right_ts_name: str = "reading_timestamp",
    chunk_seconds: int = 600,
) -> DataFrame:
    """C5 in batch: every left row with the right row of the same keys nearest in time, if one lies within the
    bound (inclusive); of two as near the earlier one, of two at one time the greatest. NULL keys or times never
    match.

    No pairs: both sides are stacked, and the last right row at or before, and the first one after, a left row are
    carried to it -- one shuffle of the rows by (key, chunk of ``chunk_seconds``), so that neither a key nor its
    history is one task. Times of the left and right side are of one type, and the right columns can be ordered."""
    if bound_seconds <= 0:
        raise ValueError("bound_seconds must be positive")
    hit = F.struct(F.col(right_ts).alias(right_ts_name), F.struct(*[F.col(c) for c in right_cols]).alias("row"))
    known = lambda df, ts: df.dropna(subset=list(dict.fromkeys([*keys, ts])))
    r = known(right, right_ts).select(*keys, F.col(right_ts).alias("_t"), F.lit(0).alias("_side"), hit.alias("_hit"))
    l = known(left, left_ts).select(*keys, F.col(left_ts).alias("_t"), F.lit(1).alias("_side"), F.struct(*[F.col(c) for c in left_cols]).alias("_left"))
    both = r.unionByName(l, allowMissingColumns=True)
    # right rows before left rows of the same time: "prev" is at or before, "next" is after
    order, value = ["_t", "_side", "_hit"], F.col("_hit")
    both = partition_by_key_and_chunk(both, keys, F.floor(F.unix_seconds(F.col("_t").cast("timestamp")) / chunk_seconds))
    before, after = Window.partitionBy(KEY, CHUNK).orderBy("_t", "_side", "_hit"), Window.partitionBy(KEY, CHUNK).orderBy(*map(F.desc, ("_t", "_side", "_hit")))
    earlier, later = Window.partitionBy(KEY).orderBy(CHUNK), Window.partitionBy(KEY).orderBy(F.desc(CHUNK))
    so_far = lambda c, w: F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    # one summary of the chunks, with their first and last right rows, carries both ways across them
    edges = both.groupBy(KEY, CHUNK).agg(F.min("_hit").alias("_first"), F.max("_hit").alias("_last"))
    edges = edges.select(KEY, CHUNK, so_far("_last", earlier).alias("_chunk_before"), so_far("_first", later).alias("_chunk_after"))
    both = both.withColumn("_before", so_far("_hit", before)).withColumn("_after", so_far("_hit", after)).where("_side = 1").join(edges, [KEY, CHUNK])
    both = both.withColumn("_before", F.coalesce("_before", "_chunk_before")).withColumn("_after", F.coalesce("_after", "_chunk_after"))
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    back, ahead = micros("_t") - micros(f"_before.{right_ts_name}"), micros(f"_after.{right_ts_name}") - micros("_t")
    nearest = both.select(
        "_left", F.when(ahead.isNull() | (back <= ahead), F.col("_before")).otherwise(F.col("_after")).alias("_best"), F.least(back, ahead).alias("_gap")
    )
    return nearest.where(F.col("_gap") <= bound_seconds * 1_000_000).select(
        *[F.col(f"_left.{c}").alias(c) for c in left_cols], F.col(f"_best.{right_ts_name}"), *[F.col(f"_best.row.{c}").alias(c) for c in right_cols]
    )


def nearest_match(
    pairs: DataFrame,
    group_cols: Sequence[str],
    gap: Column,
    tie: Column,
    keep: Sequence[str],
) -> DataFrame:
    """C5 on a stream: one row per group -- the candidate with the smallest ``gap``, ties
    broken by the smallest ``tie``. A sort-based aggregate (``min_by`` of structs with a
    partial stage), not a window: a hot group is reduced map-side, never buffered."""
    best = F.min_by(F.struct(*[F.col(c) for c in keep]), F.struct(gap.alias("gap"), tie.alias("tie")))
    return pairs.groupBy(*group_cols).agg(best.alias("_best")).select(*group_cols, *[F.col(f"_best.{c}").alias(c) for c in keep])
