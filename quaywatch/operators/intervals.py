"""Joins of time windows with breaks, as equi-joins on the windows that a break touches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaywatch.functions.qoe import AD_BREAKS
from quaywatch.functions.time import MINUTE_MS, at_millis, millis


def ad_breaks(markers: DataFrame) -> DataFrame:
    """Markers that show ads, with start_ms and end_ms."""
    start = millis(F.col("wallclock"))
    return markers.where(F.col("break_type").isin(*AD_BREAKS)).withColumns({"start_ms": start, "end_ms": start + F.col("duration_s").cast("long") * 1000})


def touched(df: DataFrame, first_ms: Column, last_ms: Column, size_ms: int = MINUTE_MS) -> DataFrame:
    """A row, with window_start, for each window whose start is a multiple of size_ms in [first_ms, last_ms]."""
    low, high = F.ceil(first_ms / size_ms).cast("long"), F.floor(last_ms / size_ms).cast("long")
    return df.withColumn("_at", F.explode(F.when(low <= high, F.sequence(low, high)))).withColumn("window_start", at_millis(F.col("_at") * size_ms)).drop("_at")


def overlapping(markers: DataFrame, windows: DataFrame, size_ms: int = MINUTE_MS) -> DataFrame:
    """Ad breaks beside the windows they overlap, half open: window_start < end and window_end > start.

    A break touches few windows, so it is dealt out over them, and the join is
    on window_start; no pair is compared that doesn't overlap.
    """
    breaks = ad_breaks(markers).where("end_ms > start_ms")
    reach = touched(breaks, F.col("start_ms") - size_ms + 1, F.col("end_ms") - 1, size_ms)
    return reach.select("marker_id", "event_id_scte", "break_type", "window_start").join(windows, "window_start")


def active_break(windows: DataFrame, markers: DataFrame, skew_s: int = 5, size_ms: int = MINUTE_MS) -> DataFrame:
    """Windows with the marker of the first break, by (wallclock, marker_id), whose padded span holds their start.

    Both ends of the span are closed. The tag depends on the start alone, so it
    is worked out once for each start and joined to the windows.
    """
    pad = skew_s * 1000
    reach = touched(ad_breaks(markers), F.col("start_ms") - pad, F.col("end_ms") + pad, size_ms)
    first = reach.groupBy("window_start").agg(F.min(F.struct("wallclock", "marker_id", "break_type", "event_id_scte")).alias("m"))
    tags = first.select("window_start", "m.marker_id", "m.break_type", F.col("m.event_id_scte").cast("long").alias("scte_event_id"))
    return windows.join(tags, "window_start", "left")
