"""Slowly changing dimensions from snapshots (K1-K4).

``scd2`` turns a set of snapshot rows into a version history: one row per
change of the tracked columns, with ``__START_AT`` (the sequence value where
the version opens) and ``__END_AT`` (where the next version opens; NULL =
current), half-open ``[start, end)``, both of the sequence column's type.

Semantics:
* change detection compares each snapshot with the previous one of the key
  (NULL-safe), not any change-type column; a value returning (A -> B -> A)
  opens a new version;
* ``track=None`` tracks every column (so a changing sequence column opens a
  version per snapshot); ``track_except`` removes columns from that set;
* rows with a NULL sequence are rejected; rows with the same key and sequence
  collapse to one -- exact duplicates trivially, conflicting rows to the
  greatest row;
* late snapshots need no special case because the history is computed from
  the full snapshot set (see ``streaming.scd_stream`` for the incremental form).

Plan: one hash aggregate on (key, sequence) for the duplicate rule (map-side
partial, the sequence splits a hot key), then change detection inside chunks
and one summary of the chunks across them -- partitioned by
(key, chunk of the sequence), never by the key alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetspark.operators.sequence import CHUNK, KEY, SPLIT_ROWS, default_chunk, partition_by_key_and_chunk, with_neighbor

START_AT = "__START_AT"
END_AT = "__END_AT"


def tracked_columns(df: DataFrame, keys: Sequence[str], track, track_except) -> list[str]:
    cols = list(track) if track is not None else [c for c in df.columns if c not in keys]
    if track_except:
        cols = [c for c in cols if c not in set(track_except)]
    return cols


def latest_per_key_and_sequence(df: DataFrame, keys: Sequence[str], sequence_by: str) -> DataFrame:
    """One row per (key, sequence): the greatest row. NULL sequence rejected."""
    others = [c for c in df.columns if c not in (*keys, sequence_by)]
    if not others:
        return df.where(F.col(sequence_by).isNotNull()).dropDuplicates([*keys, sequence_by])
    return (
        df.where(F.col(sequence_by).isNotNull())
        .groupBy(*keys, sequence_by)
        .agg(F.max(F.struct(*[F.col(c) for c in others])).alias("_row"))
        .select(*keys, sequence_by, *[F.col(f"_row.{c}").alias(c) for c in others])
        .select(*df.columns)
    )


def scd2(
    df: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    track: Sequence[str] | None = None,
    track_except: Sequence[str] | None = None,
    chunk: Column | None = None,
    split_rows: int | None = SPLIT_ROWS,
) -> DataFrame:
    """K1: version history. Output = input columns + ``__START_AT``, ``__END_AT``. A key with over ``split_rows`` snapshots
    in one chunk is split further, as measured (None: not).

    One shuffle of the snapshot rows, by (key, chunk of the sequence): the
    duplicate rule, the windows and the join with the summary all run on that
    partitioning; only per-(key, chunk) summaries move after it.
    """
    keys = list(keys)
    cols = df.columns
    tracked = tracked_columns(df, keys, track, track_except)
    chunk = default_chunk(df, sequence_by) if chunk is None else chunk
    parted = partition_by_key_and_chunk(df.where(F.col(sequence_by).isNotNull()), keys, chunk, [sequence_by], split_rows)
    # Same key and sequence: keep the greatest row (grouping keys include the
    # partitioning columns, so this aggregate needs no exchange).
    others = [c for c in cols if c not in (*keys, sequence_by)]
    if others:
        rows = (
            parted.groupBy(KEY, CHUNK, *keys, sequence_by)
            .agg(F.max(F.struct(*[F.col(c) for c in others])).alias("_row"))
            .select(KEY, CHUNK, *keys, sequence_by, *[F.col(f"_row.{c}").alias(c) for c in others])
        )
    else:
        rows = parted.dropDuplicates([KEY, CHUNK, *keys, sequence_by])
    if sequence_by in tracked:
        # The sequence is unique per key after the duplicate rule, so every
        # snapshot differs from the previous one: each row opens a version.
        changes = rows
    else:
        return _changes_only(rows, sequence_by, tracked).select(*cols, START_AT, END_AT)
    hist = with_neighbor(changes, keys, [sequence_by], F.col(sequence_by), END_AT, "next")
    return hist.withColumn(START_AT, F.col(sequence_by)).select(*cols, START_AT, END_AT)


def _changes_only(rows: DataFrame, sequence_by: str, tracked: Sequence[str]) -> DataFrame:
    """The rows that open a version, with its start and end, from rows partitioned by (key, chunk) that are unique
    per key and sequence.

    Inside a chunk the previous row tells a change. One summary of the chunks -- first and last tracked value,
    first change inside -- tells whether a chunk's first row is one, and where the next chunk with a change
    begins its versions; it is joined once and serves both."""
    w = Window.partitionBy(KEY, CHUNK).orderBy(sequence_by)
    chunks = Window.partitionBy(KEY).orderBy(CHUNK)
    later = Window.partitionBy(KEY).orderBy(F.desc(CHUNK)).rowsBetween(Window.unboundedPreceding, -1)
    # structs around the values: NULL means "no such row", not "a NULL value"
    value = F.struct(F.struct(*[F.col(c) for c in tracked]).alias("v")) if tracked else F.struct(F.lit(True).alias("v"))
    d = rows.withColumn("_t", value).withColumn("_prev", F.lag("_t").over(w))
    inside = F.col("_prev").isNotNull() & ~F.col("_t").eqNullSafe(F.col("_prev"))
    seq = F.col(sequence_by)
    edges = d.groupBy(KEY, CHUNK).agg(
        F.min(seq).alias("_first_at"), F.min_by("_t", seq).alias("_first"), F.max_by("_t", seq).alias("_last"),
        F.min(F.when(inside, seq)).alias("_inside_at"),
    )
    before = F.lag("_last").over(chunks)
    edges = edges.withColumn("_opens", F.coalesce(~F.col("_first").eqNullSafe(before), F.lit(True)))
    edges = edges.withColumn("_change_at", F.when(F.col("_opens"), F.col("_first_at")).otherwise(F.col("_inside_at")))
    edges = edges.select(KEY, CHUNK, "_opens", F.last("_change_at", ignorenulls=True).over(later).alias("_next_at"))
    changes = d.join(edges, [KEY, CHUNK]).where(inside | (F.col("_prev").isNull() & F.col("_opens")))
    return changes.withColumn(START_AT, seq).withColumn(END_AT, F.coalesce(F.lead(sequence_by).over(w), "_next_at"))


def current_versions(history: DataFrame) -> DataFrame:
    """K2: the open version of every key."""
    return history.where(F.col(END_AT).isNull())


def scd1(df: DataFrame, keys: Sequence[str], sequence_by: str) -> DataFrame:
    """K4: latest row per key (greatest sequence; ties -> greatest row).

    A sort-based aggregate (the buffer is a struct) with a partial stage: a hot key is reduced map-side."""
    others = [c for c in df.columns if c not in keys]
    best = F.max(F.struct(F.col(sequence_by).alias("_seq"), F.struct(*[F.col(c) for c in others]).alias("_row")))
    return (
        df.where(F.col(sequence_by).isNotNull())
        .groupBy(*keys)
        .agg(best.alias("_b"))
        .select(*keys, *[F.col(f"_b._row.{c}").alias(c) for c in others])
        .select(*df.columns)
    )


def asof_join(
    facts: DataFrame,
    history: DataFrame,
    fact_key: str,
    dim_key: str,
    fact_time: str,
    dim_cols: Sequence[str],
    chunk: Column | None = None,
    split_rows: int | None = SPLIT_ROWS,
) -> DataFrame:
    """Attach to every fact the dimension version valid at the fact's time: of the versions of the key
    with ``__START_AT`` <= time the latest one, if the time is before its ``__END_AT`` (NULL: open).

    Facts before the first version, in a gap of the history, or with NULL key or time get NULLs. Of versions
    that start together the greatest (end, then columns) counts.

    One plan at every size: facts and versions are stacked and the version is carried forward with the
    chunked previous-row helper -- one shuffle by (key, chunk of time), no range join, a hot key split by
    chunk, and a chunk of over ``split_rows`` rows further, as measured (None: not).
    """
    fcols = facts.columns
    tdt = facts.schema[fact_time].dataType
    marker = "_is_version"
    version = F.struct(F.col(END_AT).cast(tdt).alias("_end"), F.struct(*[F.col(c) for c in dim_cols]).alias("dims"))
    v = history.where(F.col(START_AT).isNotNull()).select(
        F.col(dim_key).alias("_key"),
        F.col(START_AT).cast(tdt).alias("_t"),
        F.lit(0).alias(marker),
        version.alias("_ver"),
        *[F.lit(None).cast(facts.schema[c].dataType).alias(c) for c in fcols],
    )
    f = facts.select(
        F.col(fact_key).alias("_key"),
        F.col(fact_time).alias("_t"),
        F.lit(1).alias(marker),
        F.lit(None).cast(v.schema["_ver"].dataType).alias("_ver"),
        *[F.col(c) for c in fcols],
    )
    # Versions sort before facts at the same instant: the start is inclusive.
    filled = with_neighbor(
        v.unionByName(f), ["_key"], ["_t", marker, "_ver"], F.col("_ver"), "_asof", "prev", chunk, ignore_nulls=True, split_rows=split_rows
    )
    end = F.col("_asof").getField("_end")
    valid = F.col("_key").isNotNull() & F.col("_t").isNotNull() & (end.isNull() | (F.col("_t") < end))
    dims = F.when(valid, F.col("_asof").getField("dims"))
    return filled.where(F.col(marker) == 1).select(
        *[F.col(c) for c in fcols], *[dims.getField(c).alias(c) for c in dim_cols]
    )
