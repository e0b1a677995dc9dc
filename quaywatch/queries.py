"""The telemetry queries over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaywatch import flows
from quaywatch.operators import intervals, scratch, staging
from quaywatch.plans import alerts, batch, checks, marts, serving, speed
from quaywatch.sources import fixtures


def staged(spark: SparkSession, d: str) -> DataFrame:
    return staging.player_events(fixtures.player(spark, d))


def _mart(spark: SparkSession, d: str) -> DataFrame:
    return marts.session_window_qoe(staged(spark, d), staging.latest_content(fixtures.content(spark, d)))


def _speed(spark: SparkSession, d: str) -> DataFrame:
    return speed.windows(staged(spark, d))


def dedupe_global(spark: SparkSession, d: str) -> DataFrame:
    return staging.dedupe_events(fixtures.player(spark, d)).select("event_id", "session_id", "event_time", "event_type", "_ingested_at", "_kafka_offset")


def scd_latest(spark: SparkSession, d: str) -> DataFrame:
    return staging.latest_content(fixtures.content(spark, d))


def default_fill_network_type(spark: SparkSession, d: str) -> DataFrame:
    return staged(spark, d).groupBy("network_type").agg(F.count("*").alias("events"))


def session_complete(spark: SparkSession, d: str) -> DataFrame:
    return marts.session_complete(staged(spark, d))


def rebuffer_pairs(spark: SparkSession, d: str) -> DataFrame:
    rows = marts.rebuffer_pairs(staged(spark, d)).where("event_type in ('buffer_start', 'buffer_end')")
    return rows.groupBy("session_id", "window_start").agg(F.sum("rebuffer_ms").alias("rebuffer_ms"))


def session_window_qoe(spark: SparkSession, d: str) -> DataFrame:
    return _mart(spark, d)


def ccv(spark: SparkSession, d: str) -> DataFrame:
    return marts.ccv(_mart(spark, d))


def ad_impact(spark: SparkSession, d: str) -> DataFrame:
    return marts.ad_impact(fixtures.markers(spark, d), staged(spark, d).select("session_id", "window_start").distinct(), fixtures.ads(spark, d))


def ad_creatives(spark: SparkSession, d: str) -> DataFrame:
    return marts.ad_creatives(fixtures.markers(spark, d), fixtures.ads(spark, d))


def silver_qoe(spark: SparkSession, d: str) -> DataFrame:
    return _speed(spark, d)


def silver_marker_enrich(spark: SparkSession, d: str) -> DataFrame:
    rows = intervals.active_break(_speed(spark, d).select("session_id", "window_start"), fixtures.markers(spark, d))
    return rows.select("session_id", "window_start", "marker_id", "break_type", "scte_event_id")


def silver_dedup_on_read(spark: SparkSession, d: str) -> DataFrame:
    """Every fifth user's windows come twice, the second time later and with one event more."""
    rows = _speed(spark, d).select("session_id", "window_start", "events", F.lit(1).alias("processed_at"))
    again = rows.where(F.substring("session_id", 2, 20).cast("long") % 5 == 0).select("session_id", "window_start", F.col("events") + 1, F.lit(2))
    return staging.dedupe_on_read(rows.union(again))


def burn_rate_by_minute(spark: SparkSession, d: str) -> DataFrame:
    return alerts.burn_rates(alerts.population(_speed(spark, d)))


def cdn_alert_transitions(spark: SparkSession, d: str) -> DataFrame:
    return alerts.transitions(_speed(spark, d))


def cdn_alert_transitions_by_row(spark: SparkSession, d: str) -> DataFrame:
    return alerts.transitions(_speed(spark, d), cadence="row")


def current_alerts(spark: SparkSession, d: str) -> DataFrame:
    return serving.current_alerts(cdn_alert_transitions(spark, d))


def known_cdns(spark: SparkSession, d: str) -> DataFrame:
    return serving.known_cdns(_speed(spark, d))


def ccv_by_region(spark: SparkSession, d: str) -> DataFrame:
    return serving.ccv_by_region(ccv(spark, d))


def rebuffering_by_cdn(spark: SparkSession, d: str) -> DataFrame:
    return serving.rebuffering_by_cdn(_speed(spark, d))


def unique_views_per_minute(spark: SparkSession, d: str) -> DataFrame:
    return serving.unique_views_per_minute(_speed(spark, d))


def avg_bitrate_by_cdn(spark: SparkSession, d: str) -> DataFrame:
    return serving.avg_bitrate_by_cdn(_speed(spark, d))


def qoe_by_network_type(spark: SparkSession, d: str) -> DataFrame:
    return serving.qoe_by_network_type(_mart(spark, d))


def ad_impact_panel(spark: SparkSession, d: str) -> DataFrame:
    return serving.ad_impact(ad_impact(spark, d))


def ad_creatives_panel(spark: SparkSession, d: str) -> DataFrame:
    return serving.ad_creatives(ad_creatives(spark, d))


def _once(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder, for a query that reads them several times; nothing stays in the session's cache."""
    path = scratch.folder(df.sparkSession, "once")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cdn_health(spark: SparkSession, d: str) -> DataFrame:
    windows = _once(_speed(spark, d))
    return serving.cdn_health(windows, alerts.transitions(windows))


def gold_checksum(spark: SparkSession, d: str) -> DataFrame:
    return marts.checksum(_mart(spark, d))


def _marts(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """All marts; the first, from which others follow, is built once."""
    return batch.build(fixtures.player(spark, d), fixtures.markers(spark, d), fixtures.content(spark, d), fixtures.ads(spark, d), _once)


def mart_row_counts(spark: SparkSession, d: str) -> DataFrame:
    out = None
    for name, df in _marts(spark, d).items():
        one = df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("mart"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


def dq_violations(spark: SparkSession, d: str) -> DataFrame:
    return checks.violations(_marts(spark, d))


def ingestion_lag_p95(spark: SparkSession, d: str) -> DataFrame:
    return checks.ingestion_lag_p95(fixtures.player(spark, d))


def event_count_band(spark: SparkSession, d: str) -> DataFrame:
    return checks.event_count_band(fixtures.player(spark, d))


def dedupe_ratio(spark: SparkSession, d: str) -> DataFrame:
    return checks.dedupe_ratio(fixtures.player(spark, d))


def schema_v2_share(spark: SparkSession, d: str) -> DataFrame:
    return checks.schema_v2_share(fixtures.player(spark, d))


def error_burn(spark: SparkSession, d: str) -> DataFrame:
    return checks.error_burn(_speed(spark, d))


def silver_gold_divergence(spark: SparkSession, d: str) -> DataFrame:
    events = _once(staged(spark, d))
    return checks.divergence(speed.windows(events), marts.session_window_qoe(events, staging.latest_content(fixtures.content(spark, d))))


def rebuffering_pivot(spark: SparkSession, d: str) -> DataFrame:
    """Windows by network, as the chart has them."""
    series = serving.rebuffering_by_cdn(_speed(spark, d)).withColumn("cdn", F.translate("cdn", "-", "_"))
    return series.groupBy("window_start").pivot("cdn", [f"cdn_{c}" for c in "abcd"]).agg(F.avg("rebuffering_ratio"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            dedupe_global, scd_latest, default_fill_network_type, session_complete, rebuffer_pairs, session_window_qoe, ccv, ad_impact, ad_creatives, silver_qoe, silver_marker_enrich,
            silver_dedup_on_read, burn_rate_by_minute, cdn_alert_transitions, cdn_alert_transitions_by_row, current_alerts, known_cdns, ccv_by_region, rebuffering_by_cdn, unique_views_per_minute,
            avg_bitrate_by_cdn, qoe_by_network_type, ad_impact_panel, ad_creatives_panel, cdn_health, gold_checksum, mart_row_counts, dq_violations, ingestion_lag_p95, event_count_band, dedupe_ratio,
            schema_v2_share, error_burn, silver_gold_divergence, rebuffering_pivot,
        )
    } | flows.queries()
