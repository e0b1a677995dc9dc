"""Exact marts of the batch layer."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaywatch.functions import qoe
from quaywatch.functions.time import MINUTE_MS, at_millis, millis
from quaywatch.operators.intervals import overlapping


def rebuffer_pairs(events: DataFrame) -> DataFrame:
    """Events with rebuffer_ms: of a buffer's start whose next buffer event is an end, the time to it; else 0.

    One window over the session finds the next buffer event among all events,
    so buffer events need no shuffle of their own.
    """
    buffer = F.when(qoe.kind().isin(*qoe.BUFFERING), F.struct(millis(F.col("event_time")).alias("ms"), (qoe.kind() == "buffer_end").alias("ends")))
    following = F.expr("lead(_buffer) IGNORE NULLS OVER (PARTITION BY session_id ORDER BY event_time, event_id)")
    out = events.withColumn("_buffer", buffer).withColumn("_next", following)
    gap = F.when((qoe.kind() == "buffer_start") & F.col("_next.ends"), F.col("_next.ms") - F.col("_buffer.ms")).otherwise(0)
    return out.withColumn("rebuffer_ms", gap.cast("long")).drop("_buffer", "_next")


def session_complete(events: DataFrame) -> DataFrame:
    """session_id, session_complete: whether the session ever ended."""
    return events.groupBy("session_id").agg(F.bool_or(qoe.kind().isin(*qoe.TERMINAL)).alias("session_complete"))


def session_window_qoe(events: DataFrame, content: DataFrame) -> DataFrame:
    """Metrics of each session and minute.

    Pairing, the session's end and the minute's aggregates all cluster by
    session_id, so staged events are shuffled once for the three.
    """
    whole = Window.partitionBy("session_id")
    ev = rebuffer_pairs(events).withColumn("session_complete", F.max(qoe.kind().isin(*qoe.TERMINAL)).over(whole))
    ms = millis(F.col("event_time"))
    playing = F.when(qoe.kind().isin(*qoe.PLAYING), F.col("bitrate_kbps"))
    a = ev.groupBy("session_id", "window_start").agg(
        *(qoe.first_known(c) for c in ("geo_region", "device_type", "cdn", "network_type", "content_id")),
        F.bool_or("session_complete").alias("session_complete"),
        F.count("*").alias("events"),
        F.sum("rebuffer_ms").alias("rebuffer_ms"),
        (F.max(ms) - F.min(ms)).alias("span_ms"),
        F.coalesce(F.avg(playing), F.lit(0.0)).alias("avg_bitrate_kbps"),
        qoe.count_if(qoe.kind() == "error").alias("error_count"),
        qoe.count_if(qoe.kind() == "buffer_start").alias("buffer_start_count"),
        F.bool_or(qoe.kind() == "video_start").alias("had_video_start"),
        F.bool_or(qoe.kind().isin(*qoe.TERMINAL)).alias("had_terminal"),
    )
    a = a.withColumn("watch_ms", qoe.watch(F.col("span_ms"), F.col("rebuffer_ms")))
    c = content.select("content_id", F.col("title").alias("content_title"), F.col("genre").alias("content_genre"), F.col("is_premium").alias("content_is_premium"))
    return a.join(c, "content_id", "left").select(
        "session_id", "window_start", at_millis(millis(F.col("window_start")) + MINUTE_MS).alias("window_end"), F.date_format("window_start", "yyyy-MM-dd'T'HH").alias("window_hour"),
        F.concat("session_id", F.lit("|"), F.date_format("window_start", "yyyy-MM-dd'T'HH:mm")).alias("window_key"),
        "geo_region", "device_type", "cdn", "network_type", "content_id", "content_title", "content_genre", "content_is_premium", "session_complete", "events", "rebuffer_ms", "watch_ms",
        qoe.share(F.col("rebuffer_ms"), F.col("rebuffer_ms") + F.col("watch_ms")).alias("rebuffering_ratio"), "avg_bitrate_kbps", "error_count",
        qoe.share(F.col("error_count"), F.col("events")).alias("error_rate"), "buffer_start_count", "had_video_start", (F.col("had_terminal") & ~F.col("had_video_start")).alias("exit_before_video_start"),
    )


def ccv(windows: DataFrame) -> DataFrame:
    """Concurrent viewers; a mart row is a session's, so counting rows of distinct sessions is counting rows."""
    return windows.groupBy("window_start", "window_hour", "geo_region", "device_type", "cdn").agg(F.count("session_id").alias("ccv"))


def _revenue(cpm: Column, impressions: Column) -> Column:
    """cpm * impressions / 1000 in exact decimals, to 2 digits."""
    return F.round(cpm.cast("decimal(22,2)") * impressions.cast("decimal(12,0)") / F.lit(1000).cast("decimal(4,0)"), 2).cast("double")


def ad_impact(markers: DataFrame, windows: DataFrame, ads: DataFrame) -> DataFrame:
    """Audience and revenue of each ad break that had sessions."""
    active = overlapping(markers, windows.select("session_id", "window_start")).groupBy("marker_id", "event_id_scte", "break_type").agg(F.count_distinct("session_id").alias("active_sessions"))
    sold = ads.groupBy("event_id_scte").agg(F.count("*").alias("n"), F.sum("price_cpm_brl").alias("cpm"))
    n, cpm = F.coalesce("n", F.lit(0)).cast("long"), F.coalesce(F.col("cpm").cast("decimal(22,2)"), F.lit(0).cast("decimal(22,2)"))
    return active.join(sold, "event_id_scte", "left").select(
        "marker_id", "event_id_scte", "break_type", "active_sessions", n.alias("ad_impressions"), F.round(cpm, 2).cast("double").alias("sum_cpm_brl"), _revenue(cpm, n).alias("est_revenue_brl")
    )


def ad_creatives(markers: DataFrame, ads: DataFrame) -> DataFrame:
    """Revenue of each creative in each break; breaks of one id fan out, unknown breaks have a null type."""
    sold = ads.groupBy("event_id_scte", "advertiser_id", "advertiser_name", "creative_id").agg(
        F.max("creative_duration_s").alias("creative_duration_s"), F.count("*").alias("ad_impressions"), F.sum("price_cpm_brl").alias("cpm")
    )
    breaks = markers.where(F.col("break_type").isin(*qoe.AD_BREAKS)).select("event_id_scte", "break_type")
    return sold.join(breaks, "event_id_scte", "left").select(
        "event_id_scte", "break_type", "advertiser_id", "advertiser_name", "creative_id", "creative_duration_s", "ad_impressions",
        F.round("cpm", 2).cast("double").alias("sum_cpm_brl"), _revenue(F.col("cpm"), F.col("ad_impressions")).alias("est_revenue_brl"),
    )


def ordered_checksum(windows: DataFrame) -> str:
    """MD5 of all rows as one text, in the order of their keys.

    Rows are sorted by executors and pass through the driver a partition at a
    time, so memory is bounded; the time isn't, since MD5 can't be
    divided. `checksum` is the one for large marts.
    """
    ratio = F.floor(F.col("rebuffering_ratio") * 1e6 + 0.5) / 1e6
    rows = windows.orderBy("window_key").select(F.concat_ws("|", "window_key", F.col("events").cast("string"), F.col("error_count").cast("string"), F.col("rebuffer_ms").cast("string")).alias("head"), ratio.alias("ratio"))
    total = hashlib.md5()
    for r in rows.toLocalIterator():
        total.update(f"{r.head}|{r.ratio!r}".encode())
    return total.hexdigest()


def checksum(windows: DataFrame) -> DataFrame:
    """n_rows and a digest that doesn't depend on row order; rows are hashed and summed where they are."""
    ratio = F.col("rebuffering_ratio").cast("decimal(18,6)").cast("string")
    row = F.md5(F.concat_ws("|", "window_key", F.col("events").cast("string"), F.col("error_count").cast("string"), F.col("rebuffer_ms").cast("string"), ratio).cast("binary"))
    part = F.conv(F.substring(row, 1, 15), 16, 10).cast("decimal(20,0)")
    total = windows.agg(F.count("*").alias("n_rows"), F.coalesce(F.sum(part).cast("string"), F.lit("0")).alias("total"))
    return total.select("n_rows", F.md5(F.concat(F.col("n_rows").cast("string"), F.lit(":"), "total").cast("binary")).alias("qoe_checksum"))
