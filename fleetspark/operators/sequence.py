"""Previous / next row of the same key, without one key in one task.

``lag``/``lead`` over ``Window.partitionBy(key)`` send every row of a key to
one task; with one key holding a third of all rows that task is the job. Here
rows are partitioned by ``(key, chunk)`` where ``chunk`` is monotone in the
ordering (for example the day of a timestamp). Inside a chunk the plain window
answers; the first (or last) row of a chunk takes its neighbour from a small
per-(key, chunk) summary -- one row per chunk that holds data -- whose own
window is over chunks, not rows.

Exact: chunks of a key are totally ordered, so the previous row of a chunk's
first row is the last row of the nearest earlier non-empty chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType

KEY = "_k"
CHUNK = "_chunk"


def default_chunk(df: DataFrame, order_col: str) -> Column:
    """A chunk monotone in ``order_col``: day for timestamps, month for dates,
    the first 7 characters (year-month of ISO dates) for strings, blocks of
    2^20 for integers."""
    dt = df.schema[order_col].dataType
    c = F.col(order_col)
    if isinstance(dt, (TimestampType, TimestampNTZType)):
        return F.date_trunc("DAY", c)
    if isinstance(dt, DateType):
        return F.trunc(c, "MM")
    if isinstance(dt, StringType):
        return F.substring(c, 1, 7)
    return F.floor(c / F.lit(1 << 20))


#: Most (key, chunk) groups that are split further; any other holds less than one in so many of all rows.
MOST_SPLIT = 10_000


#: Sampled rows behind each boundary; more make the parts more even.
SAMPLED = 32
#: Rows from which a (key, chunk) group is split where an operator splits by default.
SPLIT_ROWS = 1_000_000


def _with_measured_chunk(base: DataFrame, order: Sequence[str], chunk: Column, split_rows: int) -> DataFrame:
    """``_chunk`` = (chunk, part): a (key, chunk) group of over ``split_rows`` rows is cut at quantiles of its first
    order column, whatever its type: numbers, times, dates, strings.

    One aggregate over the key and order columns finds the hot groups. At most ``MOST_SPLIT`` of them, the largest, are split: a group beyond
    holds less than 1 / MOST_SPLIT of all rows. A sample of their rows, picked by a hash of key and order (so a
    recomputed task picks the same), gives about one boundary per ``split_rows`` rows; groups and boundaries are
    broadcast, and bounded by MOST_SPLIT and by the rows over ``split_rows``. Rows that tie in the first order column stay together."""
    at = F.col(order[0])
    grouped = base.withColumn("_base", F.struct(chunk.alias("c")))
    sizes = grouped.groupBy(KEY, "_base").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > split_rows)
    hot = sizes.orderBy(F.desc("_n"), KEY, "_base").limit(MOST_SPLIT)
    one_in = max(1, split_rows // SAMPLED)
    picked = grouped.where(at.isNotNull() & (F.pmod(F.xxhash64(KEY, *order), F.lit(one_in)) == 0))
    picked = picked.join(F.broadcast(hot), [KEY, "_base"]).groupBy(KEY, "_base").agg(F.sort_array(F.collect_list(at)).alias("_v"), F.max("_n").alias("_n"))
    parts = F.ceil(F.col("_n") / F.lit(split_rows)).cast("int")
    cuts = F.transform(F.sequence(F.lit(1), parts - 1), lambda i: F.get("_v", F.floor(i * F.size("_v") / parts).cast("int")))
    bounds = picked.where(parts > 1).select(KEY, "_base", F.array_distinct(cuts).alias("_cuts"))
    split = grouped.join(F.broadcast(bounds), [KEY, "_base"], "left")
    part = F.coalesce(F.size(F.filter("_cuts", lambda c: c <= at)), F.lit(0))
    # NULL order values come first
    return split.withColumn(CHUNK, F.struct(F.col("_base.c").alias("c"), F.when(at.isNull() | F.col("_cuts").isNull(), 0).otherwise(part).alias("p"))).drop("_base", "_cuts")


def partition_by_key_and_chunk(
    df: DataFrame, keys: Sequence[str], chunk: Column, order: Sequence[str] | str = (), split_rows: int | None = None
) -> DataFrame:
    """Adds ``_k`` (one non-null struct of the keys: struct equality and
    hashing treat NULL fields as equal, so NULL keys keep their own group) and
    ``_chunk`` (a non-null struct too, so that rows without an order value have a chunk that joins), and hash-partitions the rows on them -- the one full shuffle
    that every later step of ``with_neighbor`` reuses. With ``split_rows``, chunks
    with more rows are cut further by the first column of ``order``."""
    order = [order] if isinstance(order, str) else order
    keyed = df.withColumn(KEY, F.struct(*[F.col(k) for k in keys]))
    if split_rows is None:
        chunked = keyed.withColumn(CHUNK, F.struct(chunk.alias("c")))
    else:
        chunked = _with_measured_chunk(keyed, order, chunk, split_rows)
    return chunked.repartition(KEY, CHUNK)


def with_neighbor(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    out: str,
    direction: str = "prev",
    chunk: Column | None = None,
    ignore_nulls: bool = False,
    keep_partitioning: bool = False,
    split_rows: int | None = None,
) -> DataFrame:
    """Adds ``out`` = ``value`` on the previous (``direction='prev'``) or next
    row of the same key in ``order`` (ascending); NULL at the key's first /
    last row. NULL keys form their own group.

    ``ignore_nulls=False``: the immediate neighbour; ``order`` must be a total
    order within a key. ``ignore_nulls=True``: the nearest earlier (later) row
    whose ``value`` is not NULL -- a forward (backward) fill; ties in ``order``
    are fine as long as tied rows do not both carry values.

    If ``df`` already holds ``_k``/``_chunk`` (from
    ``partition_by_key_and_chunk`` or an earlier call with
    ``keep_partitioning=True``) they are used as they are and no shuffle of
    the rows happens here; ``keep_partitioning`` keeps them on the output.

    ``split_rows``: cut the chunks of a key that hold more rows, as measured
    (reads the keys and the order columns twice more).
    """
    if direction not in ("prev", "next"):
        raise ValueError(direction)
    if KEY in df.columns and CHUNK in df.columns:
        base = df
    else:
        chunk = default_chunk(df, order[0]) if chunk is None else chunk
        base = partition_by_key_and_chunk(df, keys, chunk, order, split_rows)
    if ignore_nulls:
        base = base.withColumn("_nv", F.when(value.isNotNull(), F.struct(value.alias("v"))))
    else:
        base = base.withColumn("_nv", F.struct(value.alias("v")))
    ordering = F.struct(*[F.col(c) for c in order])
    w = Window.partitionBy(KEY, CHUNK).orderBy(*[F.col(c) for c in order])
    ws = Window.partitionBy(KEY).orderBy(CHUNK)
    has_v = F.col("_nv").isNotNull()
    if direction == "prev":
        if ignore_nulls:
            inner = F.last("_nv", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
            across = F.last("_edge_v", ignorenulls=True).over(ws.rowsBetween(Window.unboundedPreceding, -1))
        else:
            # ``_nv`` is a non-null struct, so lag is NULL exactly at a chunk edge.
            inner = F.lag("_nv").over(w)
            across = F.lag("_edge_v").over(ws)
        edge_val = F.max_by("_nv", F.when(has_v, ordering))
    else:
        if ignore_nulls:
            # A fill against the order: frames that end before the row grow by one row a step, while Spark
            # recomputes frames that start after it for every row.
            back = Window.partitionBy(KEY, CHUNK).orderBy(*[F.desc(c) for c in order])
            back_s = Window.partitionBy(KEY).orderBy(F.desc(CHUNK))
            inner = F.last("_nv", ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, -1))
            across = F.last("_edge_v", ignorenulls=True).over(back_s.rowsBetween(Window.unboundedPreceding, -1))
        else:
            inner = F.lead("_nv").over(w)
            across = F.lead("_edge_v").over(ws)
        edge_val = F.min_by("_nv", F.when(has_v, ordering))
    d = base.withColumn("_in", inner)
    # Summary: one row per (key, chunk) holding data. The aggregate runs on the
    # rows as partitioned above (no exchange); only the small summary moves.
    summary = base.groupBy(KEY, CHUNK).agg(edge_val.alias("_edge_v")).withColumn("_carry", across).drop("_edge_v")
    joined = d.join(summary, [KEY, CHUNK], "left")
    res = F.coalesce(F.col("_in"), F.col("_carry"))
    drop = ["_nv", "_in", "_carry"] + ([] if keep_partitioning else [KEY, CHUNK])
    return joined.withColumn(out, res.getField("v")).drop(*drop)
