"""What dashboards read. Rows come unordered; `ordered` sorts them for display."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaywatch.functions.qoe import rounded_share, share
from quaywatch.operators import sinks

# The columns of what dashboards read.
_WINDOW = "session_id string, window_start timestamp, window_end timestamp, geo_region string, device_type string, cdn string, events long, rebuffer_ms long, watch_ms long, rebuffering_ratio double, avg_bitrate_kbps double, error_count long, error_rate double, buffer_start_count long, had_video_start boolean, exit_before_video_start boolean"
SCHEMAS = {
    "session_window_qoe": f"{_WINDOW}, window_hour string, window_key string, network_type string, content_id string, content_title string, content_genre string, content_is_premium boolean, session_complete boolean",
    "ccv": "window_start timestamp, window_hour string, geo_region string, device_type string, cdn string, ccv long",
    "ad_impact": "marker_id string, event_id_scte int, break_type string, active_sessions long, ad_impressions long, sum_cpm_brl double, est_revenue_brl double",
    "ad_creatives": "event_id_scte int, break_type string, advertiser_id string, advertiser_name string, creative_id string, creative_duration_s int, ad_impressions long, sum_cpm_brl double, est_revenue_brl double",
    "speed": f"{_WINDOW}, window_bucket string, marker_id string, break_type string, scte_event_id long, processed_at timestamp",
    "alerts": "cdn string, state string, tier string, minute long, processed_at timestamp",
}


def load(spark: SparkSession, folder: str, speed: str | None = None, alerts: str | None = None) -> dict[str, DataFrame]:
    """The marts in a folder, and the stream's windows and alerts; one that isn't there is empty, so panels of it are."""
    paths = {name: f"{folder}/{name}" for name in SCHEMAS} | {k: v for k, v in (("speed", speed), ("alerts", alerts)) if v}
    return {name: sinks.read(spark, path) if sinks.exists(spark, path) else spark.createDataFrame([], T.StructType.fromDDL(SCHEMAS[name])) for name, path in paths.items()}


def current_alerts(alerts: DataFrame) -> DataFrame:
    """The last transition of each network."""
    return alerts.groupBy("cdn").agg(F.max_by(F.struct("state", "tier"), F.struct("minute", "state", "tier")).alias("a")).select("cdn", "a.state", "a.tier")


def known_cdns(windows: DataFrame) -> DataFrame:
    return windows.where("cdn is not null").select("cdn").distinct()


def ccv_by_region(ccv: DataFrame) -> DataFrame:
    return ccv.groupBy(F.col("geo_region").alias("region")).agg(F.max("ccv").alias("peak_ccv"), rounded_share(F.sum("ccv"), F.count("ccv"), 1).alias("avg_ccv"))


def _ratio() -> Column:
    return share(F.sum("rebuffer_ms"), F.sum(F.col("rebuffer_ms") + F.col("watch_ms")))


def rebuffering_by_cdn(windows: DataFrame) -> DataFrame:
    return windows.groupBy("window_start", "cdn").agg(_ratio().alias("rebuffering_ratio"))


def unique_views_per_minute(windows: DataFrame) -> DataFrame:
    return windows.groupBy(F.col("window_start").alias("minute")).agg(F.count_distinct("session_id").alias("unique_views"))


def avg_bitrate_by_cdn(windows: DataFrame) -> DataFrame:
    """Mean bitrate weighted by time watched; the sum is exact."""
    weighted = F.sum(F.col("avg_bitrate_kbps").cast("decimal(14,2)") * F.col("watch_ms").cast("decimal(14,0)")).cast("double")
    return windows.where("watch_ms > 0").groupBy("window_start", "cdn").agg(F.coalesce(weighted / F.sum("watch_ms"), F.lit(0.0)).alias("avg_bitrate_kbps"))


def qoe_by_network_type(mart: DataFrame) -> DataFrame:
    """By network type; no rows where the mart is older than that column."""
    if "network_type" not in mart.columns:
        return mart.sparkSession.createDataFrame([], "network_type string, windows long, rebuffering_ratio double, avg_bitrate_kbps double")
    return mart.groupBy("network_type").agg(F.count("*").alias("windows"), _ratio().alias("rebuffering_ratio"), F.coalesce(F.round(F.avg("avg_bitrate_kbps"), 0), F.lit(0.0)).alias("avg_bitrate_kbps"))


def ad_impact(mart: DataFrame) -> DataFrame:
    return mart.select("event_id_scte", "break_type", "active_sessions", "ad_impressions", "sum_cpm_brl", "est_revenue_brl")


def ad_creatives(mart: DataFrame) -> DataFrame:
    return mart.select("event_id_scte", "break_type", "advertiser_name", "advertiser_id", F.col("creative_id").cast("string").alias("creative_id"), "creative_duration_s", "ad_impressions", "sum_cpm_brl", "est_revenue_brl")


def cdn_health(windows: DataFrame, alerts: DataFrame) -> DataFrame:
    """Each known network, and each with an alert that fires; tier where it does."""
    firing = current_alerts(alerts).where("state = 'FIRING'").select("cdn", "tier")
    return known_cdns(windows).join(firing, "cdn", "full").select("cdn", F.when(F.col("tier").isNull(), "healthy").otherwise("firing").alias("health"), "tier")


def by_cdn(series: DataFrame, value: str) -> DataFrame:
    """A series as a table of windows by network, as charts want it."""
    return series.groupBy("window_start").pivot("cdn").agg(F.avg(value))


def ordered(df: DataFrame) -> DataFrame:
    """For display: by revenue, peak or windows, largest first, else by time."""
    for name in ("est_revenue_brl", "peak_ccv", "windows"):
        if name in df.columns:
            return df.orderBy(F.col(name).desc(), *(c for c in df.columns if c != name))
    return df.orderBy(*df.columns)
