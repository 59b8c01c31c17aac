"""Timestamp expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def truncate_second(ts: Column) -> Column:
    """Drop the fraction of a second (the result is an instant; the session zone is UTC)."""
    return F.date_trunc("SECOND", ts)


def format_snapshot(ts: Column) -> Column:
    """``20220101T204950Z`` (the session zone is UTC)."""
    return F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'")


def next_microsecond(ts: Column) -> Column:
    """The smallest later instant: turns "seen up to" into an exclusive lower bound."""
    return ts + F.expr("interval 1 microsecond")
