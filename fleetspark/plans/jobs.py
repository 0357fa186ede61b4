"""The two jobs of the source system, end to end, through stored tables.

Batch job: the four batch sources land -> bronze -> silver (shipment/invoice,
maintenance, SCD2 master) -> gold (daily revenue, vehicle scorecard).
Stream job: the three event sources land -> bronze -> silver (gps, sensor,
delivery) -> gold (alerts, delivery performance, fuel, live status).

What a job runs, in which order and how, is read from ``plans.registry``.
Every dataset is its own available-now query with its own checkpoint, reading
its inputs from the tables written before it (the hand-over is a stored table,
as between the source pipeline's tasks), so each step drains what is new and
a re-run picks up exactly the new files. A micro-batch takes at most
``max_files`` files, so a backlog is worked off in committed pieces. Paths
and names follow ``TableNames``; what a step reads, it reads by name.

A dataset with rules is one query with one state: each row is flagged once,
then every micro-batch writes, once, the rows it keeps, those it refuses and
the counts of its rules, each to a folder of its own (``_batch=e``). So the
counts are as durable as the rows: a run that dies between two micro-batches
and starts again has counted every row once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark import schemas
from fleetspark.operators import ledger
from fleetspark.operators.expectations import ASIDE, FAILED_RULES_COL, KEPT, OUTCOME_COL, REFUSED, ExpectationSet
from fleetspark.plans import registry, silver
from fleetspark.session import path_exists, remove_path
from fleetspark.sources import ingest
from fleetspark.sources.evolution import CORRUPT_COL
from fleetspark.sources.tables import BATCH, TableNames, read_static, register, register_view, static_table, stream_table, temp_view
from fleetspark.streaming import bucketed, runner, scd_stream

MAX_FILES = 1000


def rule_counts(spark: SparkSession, path: str) -> DataFrame:
    """J4 of a whole job: passed and failed rows of each rule over all micro-batches of a rules table."""
    sums = [F.sum(c).alias(c) for c in ("passed_rows", "failed_rows")]
    return read_static(spark, path).groupBy("rule", "action").agg(*sums)


def split_writer(
    rules: ExpectationSet, kept: str, refused: str, counts: str, first: tuple[ExpectationSet, str] | None = None,
    of_batch: Callable[[DataFrame], DataFrame] | None = None,
):
    """What a micro-batch of flagged rows does: one write aside, then the rows of each outcome and the counts, each once.
    ``first``: the rules ahead of ``rules``, and the table of the rows that fail them. ``of_batch`` makes the flagged rows
    of the rows that the query hands over."""

    def publish(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        at = lambda table: f"{table}/{BATCH}={epoch_id}"
        if path_exists(spark, f"{at(counts)}/_SUCCESS"):  # the last of a batch's writes
            return
        asides = [f"{counts}__incoming/{epoch_id}", f"{counts}__incoming/{epoch_id}-flagged"]
        rows = runner.kept_aside(batch, asides[0])
        if of_batch is not None:
            rows = runner.kept_aside(of_batch(rows), asides[1])
            remove_path(spark, asides[0])
        of = lambda outcome, *drop: rows.where(F.col(OUTCOME_COL) == outcome).drop(OUTCOME_COL, *drop)
        runner.write_once(of(KEPT, FAILED_RULES_COL), at(kept))
        runner.write_once(of(REFUSED), at(refused))
        found = rules.counts(rows.where(F.col(OUTCOME_COL) != ASIDE))
        if first is not None:
            runner.write_once(of(ASIDE), at(first[1]))
            found = first[0].counts(rows).unionByName(found)
        runner.write_once(found.coalesce(1), at(counts))
        for path in asides:
            remove_path(spark, path)

    return publish


def flagged_with(first: ExpectationSet, rows: DataFrame, flagged: DataFrame) -> DataFrame:
    """``flagged`` rows and those of ``rows`` that fail the first rules and so never became one of them."""
    return flagged.unionByName(first.quarantine(rows).withColumn(OUTCOME_COL, F.lit(ASIDE)), allowMissingColumns=True)


class _Lake:
    """The tables and checkpoints of one run."""

    def __init__(self, spark: SparkSession, lake_root: str, checkpoint_root: str, max_files: int | None):
        self.spark, self.max_files = spark, max_files
        self.names = TableNames.from_session(spark, lake_root)
        self.checkpoints = checkpoint_root.rstrip("/")
        self.out: dict[str, str] = {}

    def table(self, layer: str, name: str) -> tuple[str, str]:
        """Path of a table and of its checkpoint; the table is listed among the job's outputs."""
        self.out[f"{layer}.{name}"] = path = self.names.path(layer, name)
        return path, f"{self.checkpoints}/{layer}/{name}"

    def read(self, name: str, snapshot: bool) -> DataFrame:
        """An input, by its table's name."""
        known = self.names.spark_name(self.spark, registry.DATASETS[name].layer if name in registry.DATASETS else "bronze", name)
        return static_table(self.spark, known) if snapshot else stream_table(self.spark, known, self.max_files)

    def publish(self, name: str) -> None:
        """Register a table that a step has written, under its name."""
        layer, _, table = name.partition(".")
        path, known = self.out[name], self.names.spark_name(self.spark, layer, table)
        mode = registry.DATASETS[table].mode if table in registry.DATASETS and layer != "quarantine" and layer != "rules" else "append"
        if mode == "append":
            register(self.spark, known, path)
        else:
            store, part = {
                "scd2": (scd_stream.history_store, "history"), "upsert": (runner.upsert_store, "groups"), "complete": (runner.complete_store, "result"),
            }[mode]
            register_view(self.spark, known, store(self.spark, path).select(part))

    @staticmethod
    def fitting(rows: DataFrame) -> DataFrame:
        """Rows whose record could be read as a whole."""
        return silver.LINE_RULES.apply(rows) if CORRUPT_COL in rows.columns else rows

    def inputs(self, d: registry.Dataset) -> list[DataFrame]:
        return [self.fitting(self.read(n, n in d.snapshots)) for n in d.inputs]

    def run(self, d: registry.Dataset) -> None:
        path, checkpoint = self.table(d.layer, d.name)
        if d.mode == "scd2":
            snapshots = temp_view(self.inputs(d)[0], f"{d.name}_snapshots")
            scd_stream.scd2_incremental(self.spark, snapshots, path, checkpoint, silver.MASTER_KEYS, silver.MASTER_SEQUENCE)
        elif d.rules is not None:
            self.run_with_rules(d, d.rules, path, checkpoint)
        elif d.mode == "upsert":
            runner.run_upsert(d.builder(*self.inputs(d)), d.keys, path, checkpoint)
        elif d.mode == "complete":
            runner.run_complete(d.builder(*self.inputs(d)), path, checkpoint)
        else:
            runner.run_append(d.builder(*self.inputs(d)), path, checkpoint)

    def run_with_rules(self, d: registry.Dataset, rules: ExpectationSet, path: str, checkpoint: str) -> None:
        """A silver table, the rows it refuses with the rules they failed, and the counts of each rule and micro-batch; of event
        sources also the rows without a time, of CSV sources the lines that don't fit their header."""
        refused, counts = self.table("quarantine", d.name)[0], self.table("rules", d.name)[0]
        if d.inputs[0] in schemas.EVENT_SOURCES:
            bronze = self.read(d.inputs[0], False)
            first = (silver.EVENT_TIME_RULES, self.table("quarantine", f"{d.name}_untimed")[0])
            rows = flagged_with(first[0], silver.with_event_time(bronze), rules.flagged(d.prepared(bronze)))
            runner.run_update_batches(rows, split_writer(rules, path, refused, counts, first), checkpoint)
        elif d.joined_by is not None:
            stream, other = self.read(d.inputs[0], False), self.fitting(self.read(d.inputs[1], False))
            copy, copied = self.table("bronze", f"{d.inputs[1]}_by_{d.joined_by}")
            bucketed.fill(other, d.joined_by, copy, copied)
            join = bucketed.joining(self.spark, copy, other.schema, d.joined_by, lambda rows, match: rules.flagged(d.prepared(rows, match)))
            runner.run_update_batches(stream, split_writer(rules, path, refused, counts, of_batch=join), checkpoint)
        else:
            bronze = self.read(d.inputs[0], False)
            first = (silver.LINE_RULES, self.table("quarantine", f"{d.name}_unread")[0]) if CORRUPT_COL in bronze.columns else None
            rows = rules.flagged(d.prepared(self.fitting(bronze)))
            rows = flagged_with(first[0], bronze, rows) if first else rows
            runner.run_update_batches(rows, split_writer(rules, path, refused, counts, first), checkpoint)

    def run_job(self, job: str) -> dict[str, str]:
        wanted = [d for d in map(registry.DATASETS.get, registry.order()) if d.job == job]
        sources = [n for d in wanted for n in d.inputs if n not in registry.DATASETS]
        self.out.update({f"bronze.{n}": self.names.bronze_table(n) for n in sources})
        for n in sources:
            self.publish(f"bronze.{n}")
        for d in wanted:
            before = set(self.out)
            self.run(d)
            for n in self.out.keys() - before:
                self.publish(n)
        return self.out


def event_ledger(spark: SparkSession, out: dict[str, str]) -> DataFrame:
    """What became of the bronze rows of each event source, from the tables of a stream job."""
    parts = None
    for source in schemas.EVENT_SOURCES:
        name = f"{source}_silver"
        bronze = silver.with_event_time(read_static(spark, out[f"bronze.{source}"]))
        tables = [read_static(spark, out[t]) for t in (f"silver.{name}", f"quarantine.{name}", f"quarantine.{name}_untimed")]
        part = ledger.reconcile(name, bronze, *tables, bronze.columns, silver.EVENT_KEY)
        parts = part if parts is None else parts.unionByName(part)
    return parts


def run_batch_job(
    spark: SparkSession, landing_root: str, lake_root: str, checkpoint_root: str, max_files: int | None = MAX_FILES, archive: str | None = None,
    purge: bool = False,
) -> dict[str, str]:
    lake = _Lake(spark, lake_root, checkpoint_root, max_files)
    bronze = lake.names.path("bronze", "").rstrip("/")
    ingest.ingest_batch_sources(spark, landing_root, bronze, f"{lake.checkpoints}/bronze", max_files=max_files, rescue=True, archive=archive, purge=purge)
    return lake.run_job("batch")


def run_stream_job(
    spark: SparkSession, landing_root: str, lake_root: str, checkpoint_root: str, max_files: int | None = MAX_FILES, archive: str | None = None
) -> dict[str, str]:
    lake = _Lake(spark, lake_root, checkpoint_root, max_files)
    bronze = lake.names.path("bronze", "").rstrip("/")
    ingest.await_all(ingest.start_stream_ingestion(spark, landing_root, bronze, f"{lake.checkpoints}/bronze", max_files=max_files, rescue=True, archive=archive))
    return lake.run_job("stream")
