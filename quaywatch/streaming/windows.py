"""The speed layer as a stream: dedupe, tumbling windows, tags and append.

The watermark is global and moves by batch. Windows come out once, when it
passes their end. For results equal to the batch's, give the stream a delay of
the largest lateness; a record later than that is dropped and counted in the
state operators' numRowsDroppedByWatermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quaywatch.functions import qoe
from quaywatch.operators import sinks
from quaywatch.operators.intervals import active_break
from quaywatch.plans import speed
from quaywatch.sources import landing


def decoded(raw: DataFrame) -> DataFrame:
    """Wire records with event_time, device_type and geo_region, and their arrival where the stream has it."""
    arrival = [c for c in landing.ARRIVAL if c in raw.columns]
    return raw.select("event_id", "session_id", F.to_timestamp("timestamp").alias("event_time"), "event_type", "cdn", "bitrate_kbps", F.col("device.type").alias("device_type"), F.col("geo.region").alias("geo_region"), *arrival)


def windows(events: DataFrame, delay: str = "10 seconds", size_s: int = 60, dedupe: bool = True) -> DataFrame:
    """Metrics of each session and window, in the columns of `speed.windows`; event_time is a TIMESTAMP.

    dedupe: copies of a session's event within the watermark go, without a
    state of their own beyond it.
    """
    e = events.withWatermark("event_time", delay)
    if dedupe:
        e = e.dropDuplicatesWithinWatermark(["session_id", "event_id"])
    folded = e.groupBy("session_id", F.window("event_time", f"{size_s} seconds").alias("w")).agg(*qoe.window_aggregates())
    return speed.finalised(folded.withColumn("window_start", F.col("w.start").cast("timestamp_ntz")).drop("w"), size_s * 1000)


def tagged(rows: DataFrame, markers: DataFrame, size_s: int = 60) -> DataFrame:
    """With the break that is on at the window's start, and processed_at; markers are static, or read anew by `to_table`."""
    return active_break(rows, markers, size_ms=size_s * 1000).withColumn("processed_at", F.current_timestamp())


def to_table(rows: DataFrame, path: str, checkpoint: str, partition_by: str = "window_bucket", trigger: dict | None = None, markers=None, size_s: int = 60) -> StreamingQuery:
    """Append to a table that `sinks.compact` can rewrite; a batch that is run again adds copies, which `staging.dedupe_on_read` leaves out.

    markers: a function that reads the marker table; it's called for each batch, so markers that arrive later count from then on.
    """

    def batch(df: DataFrame, _: int) -> None:
        out = df.withColumn("processed_at", F.current_timestamp()) if markers is None else tagged(df, markers(), size_s)
        out.write.mode("append").partitionBy(partition_by).parquet(path)

    return rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def upsert_to_table(rows: DataFrame, path: str, checkpoint: str, keys: tuple[str, ...] = ("session_id", "window_start", "window_bucket"), trigger: dict | None = None) -> StreamingQuery:
    """Each batch replaces the rows of its keys and adds the others; a batch that is run again changes nothing.

    Appending is cheaper, and `staging.dedupe_on_read` makes up for copies; this is for readers that can't.
    """

    def batch(df: DataFrame, _: int) -> None:
        sinks.upsert(df, path, list(keys), ["window_bucket"])

    return rows.withColumn("processed_at", F.current_timestamp()).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def late_to_table(events: DataFrame, path: str, checkpoint: str, delay_s: float, trigger: dict | None = None) -> StreamingQuery:
    """Events that came later than the delay behind the latest event of earlier batches, appended to a table.

    The rows themselves, beside the count that the windows' state reports. The
    latest event of each batch is kept beside the table, so a restart goes on from it.
    """
    seen = f"{path}-seen"

    def batch(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        earlier = spark.read.parquet(seen).where(F.col("batch") < number).agg(F.max("latest")).first()[0] if sinks.exists(spark, seen) else None
        df.persist()
        if earlier is not None:
            df.where(F.col("event_time") < F.lit(earlier) - F.make_dt_interval(secs=F.lit(delay_s).cast("decimal(18,6)"))).write.mode("append").parquet(path)
        df.agg(F.max("event_time").alias("latest")).where("latest is not null").withColumn("batch", F.lit(number).cast("long")).coalesce(1).write.mode("append").parquet(seen)
        df.unpersist()

    return events.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
