"""Rows that the marts start from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaywatch.functions.time import minute_start


def newest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row of each key, the first in `order`; Spark limits the groups before it shuffles them."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def dedupe_events(landed: DataFrame) -> DataFrame:
    """Of each event_id the copy that was ingested first."""
    return newest(landed, ["event_id"], [F.col("_ingested_at"), F.col("_kafka_offset")])


def fill_network_type(events: DataFrame) -> DataFrame:
    """Version 1 events, which lack network_type, count as `unknown`."""
    return events.withColumn("network_type", F.coalesce("network_type", F.lit("unknown")))


def player_events(landed: DataFrame) -> DataFrame:
    return fill_network_type(dedupe_events(landed)).withColumn("window_start", minute_start(F.col("event_time")))


def latest_content(content: DataFrame) -> DataFrame:
    """The last version of each content; of versions of one time, the greatest title."""
    return newest(content, ["content_id"], [F.col("updated_at").desc(), F.col("title").desc()])


def dedupe_on_read(windows: DataFrame) -> DataFrame:
    """Of each session and window the row that was processed last; ties go to the most events."""
    return newest(windows, ["session_id", "window_start"], [F.col("processed_at").desc(), F.col("events").desc()])
