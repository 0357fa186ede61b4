"""Landing-zone ingestion to bronze.

A landing directory per source receives JSON or CSV files. Each ingest is a
Structured Streaming query over the native file source: new files are
discovered, each processed exactly once (the offset log in the checkpoint
records which files were taken, the parquet sink's commit log makes the
output exactly-once across restarts), rows get three metadata columns, and
the query drains with the available-now trigger and stops.

Scale notes: the file source lists the directory per micro-batch; on very
large landing zones use ``maxFilesPerTrigger`` to bound a batch, and an
archive folder, to which files move once they are taken, to bound the listing.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from fleetspark import schemas
from fleetspark.session import files_in, names_in, remove_path, table_codec
from fleetspark.sources.evolution import CORRUPT_COL, LINE, RESCUE_COL, csv_lines, parse_csv_by_header, parse_with_rescue
from fleetspark.sources.tables import BATCH
from fleetspark.streaming.runner import run_update_batches, write_once

METADATA_COLS = ["_ingested_at", "_source_file", "_source_name"]


def landing_stream(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: StructType,
    options: Mapping[str, str] | None = None,
    rescue: bool = False,
) -> DataFrame:
    """A1 / A2: new files of ``path`` as a stream, fixed schema. CSV has a
    header; malformed values become NULL (PERMISSIVE).

    ``rescue`` (O4) adds ``_rescued_data``, the JSON text of the fields the schema does not know (NULL if there
    are none), and ``_corrupt_record``, the text of a record that can't be parsed. For JSON only: the columns of a CSV
    file follow its header, which takes a micro-batch to find (``ingest_source``)."""
    if rescue and fmt != "json":
        raise ValueError("CSV with rescue is read by ingest_source")
    if rescue:
        reader = spark.readStream
        for k, v in (options or {}).items():
            reader = reader.option(k, v)
        text = reader.format("text").load(path).select("value", "_metadata").where(F.trim("value") != "")
        parsed = parse_with_rescue(text, schema, options=dict(options or {}), corrupt=True, keep=("_metadata",))
        unknown = F.when(F.size(RESCUE_COL) > 0, F.to_json(RESCUE_COL))
        return parsed.withColumn(RESCUE_COL, unknown)
    reader = spark.readStream.schema(schema).option("mode", "PERMISSIVE")
    if fmt == "csv":
        reader = reader.option("header", "true")
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.format(fmt).load(path)


def with_ingest_metadata(df: DataFrame, source_name: str) -> DataFrame:
    """A3: ingestion time, the file each row came from, the source name."""
    return (
        df.withColumn("_ingested_at", F.current_timestamp())
        .withColumn("_source_file", F.col("_metadata.file_path"))
        .withColumn("_source_name", F.lit(source_name))
        .drop("_metadata")
    )


def write_append(
    df: DataFrame,
    table_path: str,
    checkpoint: str,
    query_name: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """A4 / A5: append to a parquet table with a checkpoint; available-now
    trigger drains what has landed and stops."""
    w = df.writeStream.format("parquet").outputMode("append").option("path", table_path)
    w = w.option("checkpointLocation", checkpoint).option("compression", table_codec(df.sparkSession))
    if query_name:
        w = w.queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def ingest_source(
    spark: SparkSession,
    source_name: str,
    landing_path: str,
    table_path: str,
    checkpoint: str,
    fmt: str | None = None,
    schema: StructType | None = None,
    query_name: str | None = None,
    wait: bool = True,
    options: Mapping[str, str] | None = None,
    rescue: bool = False,
    archive: str | None = None,
) -> StreamingQuery:
    """A6 / A7 for one source: landing files -> bronze parquet table.

    ``archive``: a folder outside the landing folder that files move to once the micro-batch that took them is done with, so that
    later micro-batches list what is new and not all that ever landed. A file moves when the next micro-batch begins; the checkpoint
    still knows it, so no row comes twice, moved or not."""
    if archive:
        options = {**(options or {}), "cleanSource": "archive", "sourceArchiveDir": archive}
    fmt = fmt or schemas.SOURCE_FORMAT[source_name]
    schema = schema or schemas.schema(source_name)
    if rescue and fmt == "csv":
        return _ingest_csv_by_header(spark, source_name, landing_path, table_path, checkpoint, schema, query_name, wait, options)
    df = with_ingest_metadata(landing_stream(spark, landing_path, fmt, schema, options, rescue), source_name)
    q = write_append(df, table_path, checkpoint, query_name)
    if wait:
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    return q


def _ingest_csv_by_header(
    spark: SparkSession, source_name: str, landing_path: str, table_path: str, checkpoint: str, schema: StructType,
    query_name: str | None, wait: bool, options: Mapping[str, str] | None,
) -> StreamingQuery:
    """CSV files whose columns may be added, missing or in another order (O4): each micro-batch finds the headers of its
    files and writes its rows once, to a folder of its own."""
    reader = spark.readStream.format("text")
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    lines = csv_lines(reader.load(landing_path).select(LINE, "_metadata"))

    def publish(batch: DataFrame, epoch_id: int) -> None:
        rows = parse_csv_by_header(batch, schema, keep=("_metadata",))
        write_once(with_ingest_metadata(rows, source_name), f"{table_path}/{BATCH}={epoch_id}")

    return run_update_batches(lines, publish, checkpoint, query_name, wait)


def _bound(max_files: int | None) -> dict[str, str]:
    return {"maxFilesPerTrigger": str(max_files)} if max_files else {}


def ingest_batch_sources(
    spark: SparkSession,
    landing_root: str,
    bronze_root: str,
    checkpoint_root: str,
    sources: Iterable[str] = schemas.BATCH_SOURCES,
    max_files: int | None = None,
    rescue: bool = False,
    archive: str | None = None,
    purge: bool = False,
) -> dict[str, str]:
    """The batch sources one after another; returns source -> table path. ``purge``: a source's files go as soon as its table
    holds their rows (``remove_taken``), so that a record isn't stored twice for longer than its source's ingest takes."""
    out = {}
    for name in sources:
        table = f"{bronze_root}/{name}"
        ingest_source(spark, name, f"{landing_root}/{name}", table, f"{checkpoint_root}/{name}", options=_bound(max_files), rescue=rescue, archive=archive)
        if purge:
            remove_taken(spark, f"{landing_root}/{name}", table)
        out[name] = table
    return out


def remove_taken(spark: SparkSession, landing_path: str, table_path: str) -> None:
    """Delete the files of a landing folder whose rows a table holds; no ingest into the table may be running. Others stay: those
    that have landed since, be it under a name that was taken before, and those without a row."""
    there = files_in(spark, landing_path)
    if there and names_in(spark, table_path):
        of = F.replace("_source_file", F.lit(":///"), F.lit(":/")).alias("file")
        held = spark.read.parquet(table_path).where(of.isin([*there])).groupBy(of)
        held = held.agg(F.unix_millis(F.max("_ingested_at")).alias("taken_at"))
        for r in held.collect():  # at most what the folder holds
            path, changed_at = there[r.file]
            if changed_at <= r.taken_at:
                remove_path(spark, path)


def start_stream_ingestion(
    spark: SparkSession,
    landing_root: str,
    bronze_root: str,
    checkpoint_root: str,
    sources: Iterable[str] = schemas.EVENT_SOURCES,
    max_files: int | None = None,
    rescue: bool = False,
    archive: str | None = None,
) -> dict[str, StreamingQuery]:
    """The event sources as concurrent queries named ``bronze_<source>``.
    Callers wait with ``await_all`` before reading the tables (unlike the
    source notebook, which counted while the drains might still run)."""
    return {
        name: ingest_source(
            spark, name, f"{landing_root}/{name}", f"{bronze_root}/{name}", f"{checkpoint_root}/{name}",
            query_name=f"bronze_{name}", wait=False, options=_bound(max_files), rescue=rescue, archive=archive,
        )
        for name in sources
    }


def await_all(queries: Mapping[str, StreamingQuery]) -> None:
    for q in queries.values():
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()


def stream_status(queries: Mapping[str, StreamingQuery]) -> list[dict]:
    """Name, active flag and last batch id of every query."""
    out = []
    for name, q in queries.items():
        p = q.lastProgress
        out.append({"source": name, "name": q.name, "active": q.isActive, "last_batch": p["batchId"] if p else None})
    return out


def stop_all(queries: Mapping[str, StreamingQuery]) -> None:
    for q in queries.values():
        q.stop()


def read_landing_batch(spark: SparkSession, path: str, fmt: str, schema: StructType | None = None) -> DataFrame:
    """One-off batch read-back; JSON infers the schema, CSV reads
    every column as string, unless a schema is given."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", "true")
    return reader.format(fmt).load(path)


def table_counts(spark: SparkSession, tables: Mapping[str, str], fmt: str = "parquet", tolerate_missing: bool = True) -> DataFrame:
    """One row per table -- name and row count (NULL when the table
    does not exist yet and ``tolerate_missing``). The counts are one union
    job, not a driver loop of jobs; each count reads parquet metadata only."""
    parts = []
    for name, path in tables.items():
        try:
            df = spark.read.format(fmt).load(path)
        except AnalysisException as e:
            if not tolerate_missing or e.getCondition() != "PATH_NOT_FOUND":
                raise
            parts.append(spark.range(1).select(F.lit(name).alias("table_name"), F.lit(None).cast("bigint").alias("row_count")))
            continue
        parts.append(df.groupBy().agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
