"""Times as milliseconds and back; both timestamp types, read as UTC wall clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"
MINUTE_MS = 60_000


def millis(t: Column) -> Column:
    """Whole milliseconds since the epoch, rounded down."""
    return F.floor(F.timestamp_diff("MICROSECOND", F.expr(EPOCH), t.cast("timestamp_ntz")) / 1000).cast("long")


def at_millis(ms: Column) -> Column:
    return F.expr(EPOCH) + F.make_dt_interval(secs=(ms.cast("decimal(18,3)") / 1000).cast("decimal(18,6)"))


def minute_index(t: Column) -> Column:
    return F.floor(millis(t) / MINUTE_MS).cast("long")


def minute_start(t: Column) -> Column:
    return at_millis(minute_index(t) * MINUTE_MS)
