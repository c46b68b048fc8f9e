"""Exact integer time arithmetic on microseconds since the epoch."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR = 3_600_000_000
DAY = 24 * HOUR


def micros(ts: str | Column) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, ts.cast("timestamp_ntz"))


def from_micros(us: Column) -> Column:
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", us, epoch)


def floor_to(us: Column, width: int, origin: Column | int = 0) -> Column:
    """Start of the left-closed bin of ``width`` microseconds that holds ``us``."""
    origin = F.lit(origin) if isinstance(origin, int) else origin
    return us - F.pmod(us - origin, F.lit(width))


def whole(unit: str, start: Column, end: Column) -> Column:
    """Whole units from start to end, truncated toward zero."""
    return F.timestamp_diff(unit, start.cast("timestamp_ntz"), end.cast("timestamp_ntz"))
