"""Conservation of rows between layers (A13, I2): where did every bronze row go?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CLASSES = ["bronze_rows", "kept_rows", "refused_rows", "untimed_rows", "duplicate_rows", "late_rows", "foreign_rows", "unexplained_rows"]


def _prints(df: DataFrame, columns: Sequence[str], keys: Sequence[str], side: str) -> DataFrame:
    """A 128-bit fingerprint of each row and the key under which the dedup sees it; NULLs count as values."""
    row = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return df.select(F.xxhash64(row).alias("f1"), F.xxhash64(F.lit(1), row).alias("f2"), F.struct(*keys).alias("key"), F.lit(side).alias("side"))


def reconcile(name: str, bronze: DataFrame, kept: DataFrame, refused: DataFrame, untimed: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """One row: the bronze rows of a dataset (those with a time carry the ``keys``) and what became of them.

    Kept, refused and untimed rows are counted in their tables. A bronze row that is in none of them is a duplicate if
    a row of its key is, and late if none is. ``foreign_rows`` are rows of the three tables that bronze doesn't
    have as often; ``unexplained_rows`` is what is left of the balance. Both are 0 unless rows were lost or made.

    Rows are compared by fingerprints of ``columns``, counted per key: two aggregates with a partial stage, no row is
    joined with another, so a key of any size is one row after it."""
    sides = [(bronze, "bronze"), (kept, "kept"), (refused, "refused"), (untimed, "untimed")]
    every = None
    for df, side in sides:
        part = _prints(df, columns, keys, side)
        every = part if every is None else every.unionByName(part)
    n = lambda *s: F.count_if(F.col("side").isin(*s))
    rows = every.groupBy("key", "f1", "f2").agg(n("bronze").alias("b"), n("kept").alias("k"), n("refused").alias("r"), n("untimed").alias("u"))
    rows = rows.withColumn("out", F.col("k") + F.col("r") + F.col("u"))
    missing, foreign = F.greatest(F.col("b") - F.col("out"), F.lit(0)), F.greatest(F.col("out") - F.col("b"), F.lit(0))
    by_key = rows.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("b", "k", "r", "u")], F.sum(missing).alias("missing"), F.sum(foreign).alias("foreign"), F.max(F.col("out") > 0).alias("seen"))
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).alias(name)
    out = by_key.agg(
        total("b", "bronze_rows"), total("k", "kept_rows"), total("r", "refused_rows"), total("u", "untimed_rows"),
        total(F.when(F.col("seen"), F.col("missing")).otherwise(0), "duplicate_rows"), total(F.when(F.col("seen"), 0).otherwise(F.col("missing")), "late_rows"),
        total("foreign", "foreign_rows"),
    )
    explained = F.col("kept_rows") + F.col("refused_rows") + F.col("untimed_rows") + F.col("duplicate_rows") + F.col("late_rows") - F.col("foreign_rows")
    return out.select(F.lit(name).alias("dataset"), *CLASSES[:-1], (F.col("bronze_rows") - explained).alias("unexplained_rows"))
