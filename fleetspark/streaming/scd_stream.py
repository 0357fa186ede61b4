"""Incremental SCD2 over a stream of snapshots (K5).

A late snapshot changes little: whether it differs from the snapshot before it, whether the one after it differs from
it, and where the version before it ends. So a micro-batch works on the *parts* of its keys that it touches (a part is a
month of the sequence, or a block of numbers) and on the few others whose versions change with them, never on
whole histories.

Three tables (``keyed_store``), cut by key bucket and part, are committed together:

* ``snapshots``  one row a key and sequence value (the greatest of conflicting ones), as history alone can't absorb
  a late snapshot: a late B between two collapsed A's re-opens A;
* ``edges``      a row a key and part: first and last tracked values, first change inside, whether its first row opens
  a version (it differs from the last row of the part before) and where the next change after the part lies;
* ``history``    the versions, in the part in which they start.

Per micro-batch: the new rows join the snapshots of the touched cells; their edges are computed anew and compared, over
the parts of each touched key, with the stored ones. Affected are the touched parts, a later part whose first row now
opens, or no longer opens, a version, and an earlier part whose last version ends elsewhere. Only those parts'
versions are computed, from their snapshots, and spliced into the cells they lie in; all other rows of those cells are
carried over and all other cells stay as they are. A key with very many rows in one part is split further (``sequence``).

A replayed epoch that was committed changes nothing; one that wasn't starts from the last committed state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, StringType, StructType, TimestampNTZType, TimestampType

from fleetspark.operators.scd import END_AT, START_AT, tracked_columns
from fleetspark.operators.sequence import with_neighbor
from fleetspark.session import remove_path
from fleetspark.streaming.keyed_store import KeyedStore
from fleetspark.streaming.runner import BUCKET, ID, identity, kept_aside, key_bucket, run_update_batches

PART = "_part"
CELL = [BUCKET, PART]
TABLES = {"snapshots": CELL, "edges": CELL, "history": CELL}


def sequence_part(df: DataFrame, sequence_by: str) -> Column:
    """The part of the sequence a row lies in, as a text that can stand in a path: month of times and dates, the first
    seven characters of strings (year and month of ISO dates), blocks of 2^20 numbers."""
    kind, c = df.schema[sequence_by].dataType, F.col(sequence_by)
    if isinstance(kind, (TimestampType, TimestampNTZType, DateType)):
        return F.date_format(c, "yyyyMM")
    if isinstance(kind, StringType):
        return F.hex(F.encode(F.substring(c, 1, 7), "UTF-8"))
    return F.floor(c / F.lit(1 << 20)).cast("string")


def scd2_incremental(
    spark: SparkSession,
    snapshots_stream: DataFrame,
    target_path: str,
    checkpoint: str,
    keys: Sequence[str],
    sequence_by: str,
    track: Sequence[str] | None = None,
    track_except: Sequence[str] | None = None,
    buckets: int = 64,
    wait: bool = True,
) -> StreamingQuery:
    """Keeps the history of ``scd.scd2`` over all snapshots streamed so far, in ``target_path`` (see ``read_history``)."""
    keys = list(keys)
    columns = snapshots_stream.columns
    tracked = tracked_columns(snapshots_stream, keys, track, track_except)
    others = [c for c in columns if c not in (*keys, sequence_by)]
    value = F.struct(F.struct(*[F.col(c) for c in tracked]).alias("v")) if tracked else F.struct(F.lit(True).alias("v"))
    seq = F.col(sequence_by)

    def with_changes(rows: DataFrame) -> DataFrame:
        """``_v``, and whether it differs from that of the row before it in the part: NULL for the part's first row."""
        near = with_neighbor(rows.withColumn("_v", value), [*keys, PART], [sequence_by], F.col("_v"), "_prev", "prev")
        return near.withColumn("_inside", F.when(F.col("_prev").isNotNull(), ~F.col("_v").eqNullSafe(F.col("_prev")))).drop("_prev")

    def merge(old: DataFrame, new: DataFrame) -> DataFrame:
        both = old.unionByName(new)
        if not others:
            return both.dropDuplicates([*keys, sequence_by, *CELL])
        best = both.groupBy(*keys, sequence_by, *CELL).agg(F.max(F.struct(*others)).alias("_row"))
        return best.select(*keys, sequence_by, *[F.col(f"_row.`{c}`").alias(c) for c in others], *CELL).select(*columns, *CELL)

    def apply(batch: DataFrame, epoch_id: int) -> None:
        own = batch.sparkSession
        store = KeyedStore(own, target_path, TABLES)
        if store.committed(epoch_id):
            return
        aside = f"{target_path.rstrip('/')}/incoming/{epoch_id}"
        placed = batch.where(seq.isNotNull()).withColumn(BUCKET, key_bucket(keys, buckets).cast("string"))
        new = kept_aside(placed.withColumn(PART, sequence_part(batch, sequence_by)), f"{aside}/rows")
        splice(store, new, batch.schema, epoch_id, aside)
        remove_path(own, aside)

    def splice(store: KeyedStore, new: DataFrame, schema: StructType, epoch_id: int, aside: str) -> None:
        touched = [tuple(r) for r in new.select(*CELL).distinct().collect()]  # cells, not keys
        if not touched:
            return
        written = {"snapshots": store.write("snapshots", epoch_id, merge(store.read("snapshots", schema, touched), new))}

        def snapshots(cells, parts: DataFrame) -> DataFrame:
            rows = store.read("snapshots", schema, cells, written["snapshots"])
            return rows.withColumn(ID, identity(keys)).join(parts.select(ID, *CELL), [ID, *CELL], "left_semi")

        hit = new.select(identity(keys).alias(ID), *CELL).distinct()
        changed = kept_aside(with_changes(snapshots(touched, hit)), f"{aside}/changes")
        fresh = changed.groupBy(ID, *CELL).agg(
            F.min(seq).alias("first_at"), F.min_by("_v", seq).alias("first"), F.max_by("_v", seq).alias("last"),
            F.min(F.when(F.col("_inside"), seq)).alias("inside_at"),
        )
        fresh = fresh.withColumns({"opens": F.lit(None).cast("boolean"), "next_at": F.lit(None).cast(schema[sequence_by].dataType)})
        shape = StructType([f for f in fresh.schema.fields if f.name not in CELL])
        stored = store.read("edges", shape, {(b,) for b, _ in touched})
        known = stored.join(hit.select(ID).distinct(), ID, "left_semi").join(hit, [ID, *CELL], "left_anti")
        in_order = Window.partitionBy(ID).orderBy("first_at")  # a row a part
        later = Window.partitionBy(ID).orderBy(F.desc("first_at")).rowsBetween(Window.unboundedPreceding, -1)
        edges = fresh.withColumn("_touched", F.lit(True)).unionByName(known.withColumn("_touched", F.lit(False)))
        edges = edges.withColumn("_opens", F.coalesce(~F.col("first").eqNullSafe(F.lag("last").over(in_order)), F.lit(True)))
        edges = edges.withColumn("_change_at", F.when(F.col("_opens"), F.col("first_at")).otherwise(F.col("inside_at")))
        edges = edges.withColumn("_next_at", F.last("_change_at", ignorenulls=True).over(later))
        ends_elsewhere = F.col("_change_at").isNotNull() & ~F.col("_next_at").eqNullSafe(F.col("next_at"))
        affected = edges.where(F.col("_touched") | ~F.col("_opens").eqNullSafe(F.col("opens")) | ends_elsewhere)
        affected = affected.withColumns({"opens": F.col("_opens"), "next_at": F.col("_next_at")}).select(*fresh.columns)
        affected = kept_aside(affected, f"{aside}/edges")
        cells = [tuple(r) for r in affected.select(*CELL).distinct().collect()]

        beyond = affected.join(hit, [ID, *CELL], "left_anti")
        further = [tuple(r) for r in beyond.select(*CELL).distinct().collect()]
        rows = changed.unionByName(with_changes(snapshots(further, beyond))) if further else changed
        rows = rows.join(affected.select(ID, *CELL, "opens", "next_at"), [ID, *CELL])
        opening = rows.where(F.coalesce("_inside", "opens")).withColumn(START_AT, seq)
        versions = with_neighbor(opening, [*keys, PART], [sequence_by], seq, END_AT, "next")
        versions = versions.withColumn(END_AT, F.coalesce(END_AT, "next_at")).select(*columns, START_AT, END_AT, *CELL)
        rest = store.read("history", versions.drop(*CELL).schema, cells).withColumn(ID, identity(keys))
        rest = rest.join(affected.select(ID, *CELL), [ID, *CELL], "left_anti").drop(ID)
        written["history"] = store.write("history", epoch_id, rest.unionByName(versions))
        same = store.read("edges", shape, cells).join(affected.select(ID, *CELL), [ID, *CELL], "left_anti")
        written["edges"] = store.write("edges", epoch_id, same.unionByName(affected))
        store.commit(epoch_id, written, {"snapshots": touched, "history": cells, "edges": cells})

    return run_update_batches(snapshots_stream, apply, checkpoint, wait=wait)


def history_store(spark: SparkSession, target_path: str) -> KeyedStore:
    return KeyedStore(spark, target_path, TABLES)


def read_history(spark: SparkSession, target_path: str) -> DataFrame:
    return history_store(spark, target_path).read("history").drop(*CELL)
