"""Named data-quality expectations.

A rule is a name plus a SQL predicate. ``NULL`` counts as failure: the pass
side is ``coalesce(p, false)`` and the fail side is its negation -- never
``NOT p``, which would lose NULL rows from both sides.

Actions:
  drop        row removed from the kept output (J1)
  warn        row kept, failure counted (J2)
  quarantine  row removed from the kept output and routed to the quarantine
              output with the names of every rule it failed (J5)

All rules of a set fold into one conjunction, so the kept output is one
filter (pushed into the scan where possible) and the report is one
aggregation pass with a partial (map-side) stage (J3, J4).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DROP = "drop"
WARN = "warn"
QUARANTINE = "quarantine"
ACTIONS = (DROP, WARN, QUARANTINE)

FAILED_RULES_COL = "_failed_rules"
OUTCOME_COL = "_outcome"
#: Outcomes of a row; ASIDE: refused ahead of the rules that the outcome is about.
KEPT, REFUSED, ASIDE = "kept", "refused", "aside"


@dataclass(frozen=True)
class Expectation:
    name: str
    predicate: str
    action: str = DROP

    def __post_init__(self):
        if self.action not in ACTIONS:
            raise ValueError(f"unknown action {self.action!r}")

    def passes(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))

    def fails(self) -> Column:
        return ~self.passes()


def expect(name: str, predicate: str) -> Expectation:
    return Expectation(name, predicate, WARN)


def expect_or_drop(name: str, predicate: str) -> Expectation:
    return Expectation(name, predicate, DROP)


def expect_or_quarantine(name: str, predicate: str) -> Expectation:
    return Expectation(name, predicate, QUARANTINE)


@dataclass
class ExpectationSet:
    rules: list[Expectation] = field(default_factory=list)

    def __post_init__(self):
        names = [r.name for r in self.rules]
        if len(names) != len(set(names)):
            raise ValueError("duplicate expectation names")

    def _blocking(self) -> list[Expectation]:
        return [r for r in self.rules if r.action in (DROP, QUARANTINE)]

    def keep_condition(self) -> Column:
        cond = F.lit(True)
        for r in self._blocking():
            cond = cond & r.passes()
        return cond

    # The rows that survive every blocking rule.
    def apply(self, df: DataFrame) -> DataFrame:
        if not self._blocking():
            return df
        return df.filter(self.keep_condition())

    def failed_rules(self, rules: list[Expectation] | None = None) -> Column:
        rules = self.rules if rules is None else rules
        return F.filter(
            F.array(*[F.when(r.fails(), F.lit(r.name)) for r in rules]),
            lambda x: x.isNotNull(),
        )

    # Rows failing at least one blocking rule, with every rule they failed
    # (warn rules included, so one row carries its whole diagnosis).
    def quarantine(self, df: DataFrame) -> DataFrame:
        if not self._blocking():
            return df.limit(0).withColumn(FAILED_RULES_COL, F.array().cast("array<string>"))
        return df.filter(~self.keep_condition()).withColumn(FAILED_RULES_COL, self.failed_rules())

    def flagged(self, df: DataFrame) -> DataFrame:
        """Every row with the rules it fails and its outcome: both sides and the counts of a set from one pass."""
        outcome = F.when(self.keep_condition(), F.lit(KEPT)).otherwise(F.lit(REFUSED))
        return df.withColumns({FAILED_RULES_COL: self.failed_rules(), OUTCOME_COL: outcome})

    def counts(self, flagged: DataFrame) -> DataFrame:
        """One row per rule: rule, action, passed_rows, failed_rows, of flagged rows."""
        failed = [F.count_if(F.array_contains(FAILED_RULES_COL, r.name)).alias(f"f{i}") for i, r in enumerate(self.rules)]
        wide = flagged.agg(F.count(F.lit(1)).alias("n"), *failed)
        parts = [F.struct(F.lit(r.name).alias("rule"), F.lit(r.action).alias("action"), (F.col("n") - F.col(f"f{i}")).alias("passed_rows"), F.col(f"f{i}").alias("failed_rows")) for i, r in enumerate(self.rules)]
        return wide.select(F.inline(F.array(*parts)))

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        return self.apply(df), self.quarantine(df)

    # Pass / fail counts per rule, in one aggregation pass.
    def report_wide(self, df: DataFrame) -> DataFrame:
        aggs = [F.count(F.lit(1)).alias("total_rows")]
        for r in self.rules:
            aggs.append(F.sum(F.when(r.fails(), 1).otherwise(0)).cast("bigint").alias(f"failed__{r.name}"))
        return df.agg(*aggs)

    def report(self, df: DataFrame) -> DataFrame:
        """One row per rule: rule, action, passed_rows, failed_rows."""
        wide = self.report_wide(df)
        stacked = F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(r.name).alias("rule"),
                        F.lit(r.action).alias("action"),
                        F.col(f"failed__{r.name}").alias("failed_rows"),
                    )
                    for r in self.rules
                ]
            )
        )
        return wide.select(F.col("total_rows"), stacked.alias("r")).select(
            F.col("r.rule").alias("rule"),
            F.col("r.action").alias("action"),
            (F.col("total_rows") - F.col("r.failed_rows")).alias("passed_rows"),
            F.col("r.failed_rows").alias("failed_rows"),
        )

    def observe(self, df: DataFrame, name: str) -> DataFrame:
        """J4 on a stream: the same counts as named observed metrics, reported in
        ``StreamingQuery.lastProgress['observedMetrics'][name]`` per batch."""
        aggs = [F.count(F.lit(1)).alias("total_rows")]
        for r in self.rules:
            aggs.append(F.sum(F.when(r.fails(), 1).otherwise(0)).alias(f"failed__{r.name}"))
        return df.observe(name, *aggs)
