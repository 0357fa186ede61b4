"""Column-level helpers (H1-H10). All are built-in expressions: they stay in
whole-stage codegen and are pushed down where Catalyst can."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetspark.constants import DELIVERY_STATE_ORDER


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_event_time(c: str | Column) -> Column:
    """H1: ISO-8601 string (with or without fraction / offset) -> TIMESTAMP.

    ``try_to_timestamp`` so a malformed value becomes NULL instead of failing
    the whole query under ANSI mode."""
    return F.try_to_timestamp(_c(c))


def event_date(c: str | Column) -> Column:
    """H2: calendar date of a timestamp (session time zone)."""
    return F.to_date(_c(c))


def trimmed(c: str | Column) -> Column:
    """H3."""
    return F.trim(_c(c))


def lookup(mapping: Mapping, key: str | Column) -> Column:
    """H4: value for ``key``; NULL when the key is absent or NULL (also under ANSI).

    The map is a literal of two arrays, folded once by the optimizer."""
    names, values = (F.array(*map(F.lit, side)) for side in (mapping.keys(), mapping.values()))
    return F.try_element_at(F.map_from_arrays(names, values), _c(key))


def status_order(c: str | Column = "status") -> Column:
    return lookup(DELIVERY_STATE_ORDER, c)
