"""The speed layer's windows, in batch: same columns and rules as the stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaywatch.functions import qoe
from quaywatch.functions.time import MINUTE_MS, at_millis, millis
from quaywatch.operators.intervals import active_break


def windows(events: DataFrame, size_ms: int = MINUTE_MS) -> DataFrame:
    """Metrics of each session and window; buffers pair inside the window only. One shuffle, by session."""
    start = at_millis(F.floor(millis(F.col("event_time")) / size_ms).cast("long") * size_ms)
    return finalised(events.withColumn("window_start", start).groupBy("session_id", "window_start").agg(*qoe.window_aggregates()), size_ms)


def finalised(folded: DataFrame, size_ms: int = MINUTE_MS) -> DataFrame:
    for name, value in qoe.window_metrics().items():
        folded = folded.withColumn(name, value)
    end = at_millis(millis(F.col("window_start")) + size_ms)
    return folded.select(*qoe.WINDOW_COLUMNS, "window_start", end.alias("window_end"), bucket().alias("window_bucket"))


def bucket():
    """The window's ten minutes, as a folder's name: no colons."""
    return F.concat(F.substring(F.date_format("window_start", "yyyy-MM-dd'T'HH-mm"), 1, 15), F.lit("0"))


def enriched(rows: DataFrame, markers: DataFrame, size_ms: int = MINUTE_MS) -> DataFrame:
    return active_break(rows, markers, size_ms=size_ms)
