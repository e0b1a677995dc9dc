"""Quality-of-experience formulas as columns, for batch and stream alike."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quaywatch.functions.time import millis

PLAYING = ("heartbeat", "video_start", "bitrate_switch")
BUFFERING = ("buffer_start", "buffer_end")
TERMINAL = ("video_end", "error")
AD_BREAKS = ("commercial", "blackout")


def kind() -> Column:
    return F.col("event_type")


def count_if(test: Column) -> Column:
    return F.sum(F.when(test, 1).otherwise(0)).cast("long")


def first_known(name: str, *, empty: bool = True) -> Column:
    """The column's value in the earliest event that has one; ties go by event_id. empty: whether '' is a value."""
    known = F.col(name).isNotNull() if empty else F.coalesce(F.col(name) != "", F.lit(False))
    return F.min_by(name, F.when(known, F.struct("event_time", "event_id"))).alias(name)


def watch(span: Column, rebuffer: Column) -> Column:
    return F.greatest(F.lit(0).cast("long"), span - rebuffer)


def share(part: Column, whole: Column) -> Column:
    """part / whole; 0 where whole is 0 or null."""
    return F.coalesce(F.try_divide(part.cast("double"), F.nullif(whole, F.lit(0))), F.lit(0.0))


def rounded_share(part: Column, whole: Column, digits: int) -> Column:
    """part / whole of non-negative integers, rounded half up without a detour through binary fractions; 0 where whole is 0."""
    scaled = F.floor(F.try_divide((2 * part.cast("decimal(25,0)") * 10**digits + whole).cast("decimal(38,0)"), F.nullif((2 * whole).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))))
    return F.coalesce(scaled.cast("double") / 10**digits, F.lit(0.0))


def paired_ms(events: Column) -> Column:
    """Rebuffering in a sorted array of struct(ms, event_id, starts): each start meets the next end, a later start replaces one that is open."""
    zero = F.struct(F.lit(None).cast("long").alias("open"), F.lit(0).cast("long").alias("total"))

    def step(state: Column, e: Column) -> Column:
        ended = F.struct(F.lit(None).cast("long").alias("open"), (state["total"] + F.greatest(F.lit(0).cast("long"), e["ms"] - state["open"])).alias("total"))
        return F.when(e["starts"], F.struct(e["ms"].alias("open"), state["total"].alias("total"))).when(state["open"].isNotNull(), ended).otherwise(state)

    return F.aggregate(F.array_sort(events), zero, step, lambda state: state["total"])


def window_aggregates() -> list[Column]:
    """Aggregates of a session's window in the speed layer, from which `window_metrics` follow."""
    playing = kind().isin(*PLAYING) & (F.coalesce(F.col("bitrate_kbps"), F.lit(0)) != 0)
    buffer = F.struct(millis(F.col("event_time")).alias("ms"), F.col("event_id").alias("event_id"), (kind() == "buffer_start").alias("starts"))
    return [
        *(first_known(c, empty=False) for c in ("geo_region", "device_type", "cdn")),
        F.count("*").alias("events"),
        F.sum(F.when(playing, F.col("bitrate_kbps")).otherwise(0)).cast("long").alias("bitrate_sum"),
        count_if(playing).alias("bitrate_n"),
        F.collect_list(F.when(kind().isin(*BUFFERING), buffer)).alias("buffers"),
        count_if(kind() == "error").alias("error_count"),
        count_if(kind() == "buffer_start").alias("buffer_start_count"),
        F.bool_or(kind() == "video_start").alias("had_video_start"),
        F.bool_or(kind().isin(*TERMINAL)).alias("had_terminal"),
        (F.max(millis(F.col("event_time"))) - F.min(millis(F.col("event_time")))).alias("span_ms"),
    ]


def window_metrics() -> dict[str, Column]:
    """Of the speed layer, in order: rounded to 6 and 2 digits, bitrate over non-zero values."""
    rebuffer = F.col("rebuffer_ms")
    return {
        "rebuffer_ms": paired_ms(F.col("buffers")),
        "watch_ms": watch(F.col("span_ms"), rebuffer),
        "rebuffering_ratio": rounded_share(rebuffer, rebuffer + F.col("watch_ms"), 6),
        "avg_bitrate_kbps": rounded_share(F.col("bitrate_sum"), F.col("bitrate_n"), 2),
        "error_rate": rounded_share(F.col("error_count"), F.col("events"), 6),
        "exit_before_video_start": F.col("had_terminal") & ~F.col("had_video_start"),
    }


WINDOW_COLUMNS = (
    "session_id", "geo_region", "device_type", "cdn", "events", "rebuffer_ms", "watch_ms", "rebuffering_ratio", "avg_bitrate_kbps", "error_count", "error_rate",
    "buffer_start_count", "had_video_start", "exit_before_video_start",
)
