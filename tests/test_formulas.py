"""Formulas, intervals and staging on hand-made rows."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quaywatch.operators import intervals, staging
from quaywatch.plans import marts, serving, speed

START = datetime(2026, 5, 20, 22, 14, 0)


def at(s):
    return START + timedelta(seconds=s)


def events(spark, *rows, **extra):
    """rows: (second, type, bitrate)."""
    base = {"session_id": "s1", "geo_region": "SE", "device_type": "tv", "cdn": "cdn-a", "network_type": None, "content_id": "c1"} | extra
    data = [(f"e{k:03d}", at(r[0]), r[1], r[2] if len(r) > 2 else None, *base.values()) for k, r in enumerate(rows)]
    return spark.createDataFrame(data, "event_id string, event_time timestamp_ntz, event_type string, bitrate_kbps int, " + ", ".join(f"{k} string" for k in base))


def windowed(df):
    return staging.fill_network_type(df).withColumn("window_start", F.date_trunc("minute", "event_time").cast("timestamp_ntz"))


NO_CONTENT = "content_id string, title string, genre string, is_premium boolean"


def test_rebuffering(spark):
    df = events(spark, (0, "video_start", 5000), (10, "heartbeat", 5000), (12, "buffer_start"), (14, "buffer_end"), (20, "heartbeat", 5000))
    for row in (speed.windows(df).first(), marts.session_window_qoe(windowed(df), spark.createDataFrame([], NO_CONTENT)).first()):
        assert (row.rebuffer_ms, row.watch_ms, row.events) == (2000, 18000, 5)
        assert row.rebuffering_ratio == 0.1 and row.had_video_start and not row.exit_before_video_start


def test_bitrate_and_errors(spark):
    row = speed.windows(events(spark, (0, "video_start", 4000), (10, "heartbeat", 6000), (20, "error", 6000))).first()
    assert row.avg_bitrate_kbps == 5000.0 and row.error_count == 1 and row.error_rate == 0.333333


def test_exit_before_start(spark):
    assert speed.windows(events(spark, (1, "buffer_start"), (2, "error"))).first().exit_before_video_start


def test_zero_bitrate_counts_in_the_mart_only(spark):
    df = events(spark, (0, "heartbeat", 0), (10, "heartbeat", 4000))
    assert speed.windows(df).first().avg_bitrate_kbps == 4000.0
    assert marts.session_window_qoe(windowed(df), spark.createDataFrame([], NO_CONTENT)).first().avg_bitrate_kbps == 2000.0


def test_pair_over_a_boundary(spark):
    df = events(spark, (50, "buffer_start"), (70, "buffer_end"), (75, "heartbeat", 1))
    assert [r.rebuffer_ms for r in speed.windows(df).orderBy("window_start").collect()] == [0, 0]
    rows = marts.session_window_qoe(windowed(df), spark.createDataFrame([], NO_CONTENT)).orderBy("window_start").collect()
    assert [(r.rebuffer_ms, r.watch_ms, r.rebuffering_ratio) for r in rows] == [(20000, 0, 1.0), (0, 5000, 0.0)]


def test_last_of_two_starts_counts(spark):
    df = events(spark, (10, "buffer_start"), (12, "buffer_start"), (13, "buffer_end"), (14, "buffer_end"))
    assert speed.windows(df).first().rebuffer_ms == 1000
    assert marts.session_window_qoe(windowed(df), spark.createDataFrame([], NO_CONTENT)).first().rebuffer_ms == 1000


def test_dimensions_take_the_first_that_is_known(spark):
    a = events(spark, (1, "heartbeat", 1), cdn=None, geo_region="")
    b = events(spark, (2, "heartbeat", 1), cdn="cdn-z").withColumn("event_id", F.lit("f1"))
    row = speed.windows(a.unionByName(b)).first()
    assert (row.cdn, row.geo_region) == ("cdn-z", "SE")


def test_network_type_default_and_rollup(spark):
    old = windowed(events(spark, (0, "heartbeat", 1)))
    new = windowed(events(spark, (0, "heartbeat", 1), session_id="s2", network_type="cellular"))
    mart = marts.session_window_qoe(old.unionByName(new), spark.createDataFrame([], NO_CONTENT))
    assert {r.session_id: r.network_type for r in mart.collect()} == {"s1": "unknown", "s2": "cellular"}
    rolled = spark.createDataFrame([("cellular", 100, 900, 5000.0)], "network_type string, rebuffer_ms long, watch_ms long, avg_bitrate_kbps double")
    assert serving.qoe_by_network_type(rolled).first().rebuffering_ratio == 0.1
    assert serving.qoe_by_network_type(rolled.drop("network_type")).count() == 0


def test_copies_the_first_ingested_stays(spark):
    df = spark.createDataFrame([("e1", 2, 1, "b"), ("e1", 1, 9, "a"), ("e1", 1, 10, "c"), ("e2", 5, 1, "d")], "event_id string, _ingested_at int, _kafka_offset int, x string")
    assert sorted(r.x for r in staging.dedupe_events(df).collect()) == ["a", "d"]


MARKERS = "marker_id string, event_id_scte int, break_type string, wallclock timestamp_ntz, duration_s int"


def markers(spark, *rows):
    return spark.createDataFrame([(m, e, t, at(s), d) for m, e, t, s, d in rows], MARKERS)


def windows(spark, *starts):
    return spark.createDataFrame([(f"s{k}", at(s)) for k, s in enumerate(starts)], "session_id string, window_start timestamp_ntz")


@pytest.mark.parametrize(("start", "length", "minutes"), [(0, 60, [0]), (0, 61, [0, 60]), (30, 30, [0]), (59, 2, [0, 60]), (60, 30, [60]), (30, 120, [0, 60, 120]), (10, 0, [])])
def test_overlap_is_half_open(spark, start, length, minutes):
    rows = intervals.overlapping(markers(spark, ("m", 1, "commercial", start, length)), windows(spark, -60, 0, 60, 120, 180)).collect()
    assert sorted((r.window_start - START).total_seconds() for r in rows) == minutes


def test_breaks_without_sessions_vanish_and_other_types_too(spark):
    m = markers(spark, ("far", 1, "commercial", 6000, 30), ("no", 2, "program_boundary", 0, 30), ("yes", 3, "blackout", 0, 30))
    ads = spark.createDataFrame([(3, "1.50"), (3, "2.00"), (9, "1.00")], "event_id_scte int, p string").select("event_id_scte", F.col("p").cast("decimal(10,2)").alias("price_cpm_brl"))
    rows = marts.ad_impact(m, windows(spark, 0, 0, 60), ads).collect()
    assert [(r.marker_id, r.active_sessions, r.ad_impressions, r.sum_cpm_brl, r.est_revenue_brl) for r in rows] == [("yes", 2, 2, 3.5, 0.01)]


def test_creatives_fan_out_over_breaks_of_one_id(spark):
    m = markers(spark, ("a", 1, "commercial", 0, 30), ("b", 1, "blackout", 60, 30))
    ads = spark.createDataFrame([(1, "v", "V", "c", 15, 2.0), (7, "v", "V", "c", 30, 1.0)], "event_id_scte int, advertiser_id string, advertiser_name string, creative_id string, creative_duration_s int, p double")
    rows = marts.ad_creatives(m, ads.withColumn("price_cpm_brl", F.col("p").cast("decimal(10,2)"))).collect()
    assert sorted((r.event_id_scte, str(r.break_type)) for r in rows) == [(1, "blackout"), (1, "commercial"), (7, "None")]


def test_tag_is_the_first_break_whose_padded_span_holds_the_start(spark):
    m = markers(spark, ("late", 2, "commercial", 55, 30), ("early", 1, "commercial", -30, 85), ("edge", 3, "blackout", 125, 10), ("off", 4, "program_boundary", 180, 60))
    rows = {int((r.window_start - START).total_seconds()): r.marker_id for r in intervals.active_break(windows(spark, 0, 60, 120, 180), m).collect()}
    assert rows == {0: "early", 60: "early", 120: "edge", 180: None}


def test_read_takes_the_row_processed_last(spark):
    df = spark.createDataFrame([("s", 1, 1, 5), ("s", 1, 2, 6), ("t", 1, 1, 7)], "session_id string, window_start int, processed_at int, events int")
    assert sorted(r.events for r in staging.dedupe_on_read(df).collect()) == [6, 7]


def test_current_alerts(spark):
    df = spark.createDataFrame([("a", "FIRING", "page", 1), ("a", "RESOLVED", "page", 5), ("b", "FIRING", "ticket", 2)], "cdn string, state string, tier string, minute long")
    assert {r.cdn: r.state for r in serving.current_alerts(df).collect()} == {"a": "RESOLVED", "b": "FIRING"}
    known = spark.createDataFrame([("a",), ("c",), (None,)], "cdn string")
    assert {r.cdn: r.health for r in serving.cdn_health(known, df).collect()} == {"a": "healthy", "b": "firing", "c": "healthy"}


def test_pivot_and_order(spark):
    df = spark.createDataFrame([(1, "a", 0.5), (1, "b", 0.25), (2, "a", 0.0)], "window_start int, cdn string, x double")
    assert [(r.window_start, r.a, r.b) for r in serving.by_cdn(df, "x").orderBy("window_start").collect()] == [(1, 0.5, 0.25), (2, 0.0, None)]
    assert [r.peak_ccv for r in serving.ordered(spark.createDataFrame([("x", 1), ("y", 3)], "region string, peak_ccv int")).collect()] == [3, 1]
