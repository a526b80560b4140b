"""Time helpers that work on TIMESTAMP and TIMESTAMP_NTZ columns alike."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS = {"microsecond": 1, "microseconds": 1, "second": 1_000_000, "seconds": 1_000_000,
          "minute": 60_000_000, "minutes": 60_000_000, "hour": 3_600_000_000, "hours": 3_600_000_000,
          "day": 86_400_000_000, "days": 86_400_000_000}


def duration_us(d: str | int) -> int:
    """'30 minutes' -> microseconds (ints pass through as seconds)."""
    if isinstance(d, int):
        return d * 1_000_000
    n, unit = d.split()
    return int(n) * _UNITS[unit.lower()]


def epoch_us(ts) -> Column:
    """Wall-clock microseconds since 1970-01-01 00:00:00 (no time-zone shift for NTZ)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MICROSECOND", F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")),
                            c.cast("timestamp_ntz"))


def from_epoch_us(us) -> Column:
    """Inverse of ``epoch_us``: microseconds -> TIMESTAMP_NTZ."""
    c = F.col(us) if isinstance(us, str) else us
    return F.timestamp_add("MICROSECOND", c, F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")))
