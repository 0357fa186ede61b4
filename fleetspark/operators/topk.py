"""Sorts and limits (F1, F2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, time_col: str, n: int = 10, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """the ``n`` newest rows. ``orderBy(...).limit(n)`` plans as
    TakeOrderedAndProject: each task keeps its own top n, the driver merges
    n x tasks rows -- no full sort, no shuffle of the data."""
    order: list[Column] = [F.col(time_col).desc_nulls_last()] + [F.col(c).desc_nulls_last() for c in tie_breakers]
    return df.orderBy(*order).limit(n)


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """any ``n`` rows (unordered), for eyeballing a table."""
    return df.limit(n)
