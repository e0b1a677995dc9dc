"""Data-quality checks and service levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaywatch.functions.qoe import AD_BREAKS, share
from quaywatch.functions.time import millis, minute_index
from quaywatch.plans import alerts

NOT_NULL = {
    "session_window_qoe": ("window_key", "session_id", "window_start", "rebuffering_ratio", "session_complete"),
    "ccv": ("ccv",),
    "ad_impact": ("event_id_scte",),
    "ad_creatives": ("event_id_scte", "advertiser_name", "creative_id"),
}


def violations(marts: dict[str, DataFrame]) -> DataFrame:
    """mart, check_name, violations: nulls, repeated window keys, break types that aren't ad breaks. A scan of each mart finds all its nulls."""
    out = []
    for name, columns in NOT_NULL.items():
        tests = {f"not_null_{c}": F.col(c).isNull() for c in columns}
        if name == "ad_impact":
            tests["accepted_break_type"] = ~F.col("break_type").isin(*AD_BREAKS)
        counts = marts[name].agg(*(F.coalesce(F.sum(F.when(t, 1).otherwise(0)), F.lit(0)).cast("long").alias(k) for k, t in tests.items()))
        pairs = F.explode(F.array(*(F.struct(F.lit(k).alias("check_name"), F.col(k).alias("violations")) for k in tests))).alias("x")
        out.append(counts.select(F.lit(name).alias("mart"), pairs).select("mart", "x.*"))
    keys = marts["session_window_qoe"].where("window_key is not null").groupBy("window_key").agg(F.count("*").alias("n")).where("n > 1")
    out.append(keys.agg(F.count("*").alias("violations")).select(F.lit("session_window_qoe").alias("mart"), F.lit("unique_window_key").alias("check_name"), "violations"))
    result = out[0]
    for part in out[1:]:
        result = result.unionByName(part)
    return result


def ingestion_lag_p95(landed: DataFrame) -> DataFrame:
    """Seconds between an event and its landing, by network; lags take few distinct values, which is what the exact percentile holds."""
    lag = (millis(F.col("_ingested_at")) - millis(F.col("event_time"))) / 1000
    return landed.groupBy("cdn").agg(F.percentile(lag, 0.95).alias("lag_p95_s"))


def event_count_band(landed: DataFrame, minutes: int = 15, low: float = 0.6, high: float = 3.0) -> DataFrame:
    """minute, n, median of the minutes before, in_band; null where there are none before. The window runs over a row a minute."""
    counts = landed.groupBy(minute_index(F.col("event_time")).alias("minute")).agg(F.count("*").alias("n"))
    before = Window.orderBy("minute").rangeBetween(-minutes, -1)
    median = F.percentile("n", 0.5).over(before)
    return counts.select("minute", "n", median.alias("median")).withColumn("in_band", F.col("n").between(F.col("median") * low, F.col("median") * high))


def dedupe_ratio(landed: DataFrame) -> DataFrame:
    return landed.agg(F.count("*").alias("messages"), F.count_distinct("event_id").alias("events")).withColumn("dedupe_ratio", share(F.col("messages") - F.col("events"), F.col("messages")))


def schema_v2_share(landed: DataFrame) -> DataFrame:
    return landed.agg(F.count("*").alias("messages"), F.count("network_type").alias("v2")).withColumn("v2_share", share(F.col("v2"), F.col("messages")))


def error_burn(windows: DataFrame, how: alerts.BurnRate = alerts.BurnRate()) -> DataFrame:
    """Burn rate of errors by network and minute."""
    one = alerts.burn_rates(alerts.errors(windows), how)
    return one.select("cdn", "minute", "bad", "total", F.col(f"burn_{how.fast_short}").alias("burn_short"), F.col(f"burn_{how.fast_long}").alias("burn_long"), "tier")


def divergence(speed: DataFrame, mart: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """Rebuffering of the speed layer against the mart's, by network and window, and whether it is within tolerance."""
    sums = lambda df, name: df.groupBy("cdn", "window_start").agg(F.sum("rebuffer_ms").alias(f"{name}_rebuffer"), F.sum("watch_ms").alias(f"{name}_watch"))
    both = sums(speed, "speed").join(sums(mart, "batch"), ["cdn", "window_start"], "full")
    ratio = lambda n: share(F.coalesce(F.col(f"{n}_rebuffer"), F.lit(0)), F.coalesce(F.col(f"{n}_rebuffer") + F.col(f"{n}_watch"), F.lit(0)))
    out = both.select("cdn", "window_start", ratio("speed").alias("speed_ratio"), ratio("batch").alias("batch_ratio"))
    apart = F.when(F.col("batch_ratio") > 0, F.abs(F.col("speed_ratio") - F.col("batch_ratio")) / F.col("batch_ratio")).when(F.col("speed_ratio") > 0, 1.0).otherwise(0.0)
    return out.withColumn("divergence", apart).withColumn("within", F.col("divergence") <= tolerance)


def late_share(progress: list[dict]) -> float:
    """Rows that a stream's watermark dropped, of those it read."""
    late = sum(s.get("numRowsDroppedByWatermark", 0) for p in progress for s in p.get("stateOperators", []))
    read = sum(p.get("numInputRows", 0) for p in progress)
    return late / read if read else 0.0


def watermark_lag_p95(progress: DataFrame) -> DataFrame:
    """progress: max_event_time and watermark of each batch."""
    return progress.agg(F.percentile((millis(F.col("max_event_time")) - millis(F.col("watermark"))) / 1000, 0.95).alias("lag_p95_s"))


def mart_age_hours(manifest: DataFrame, now: Column) -> DataFrame:
    """Hours since the last run in the manifest."""
    return manifest.agg(((millis(now) - F.max(millis(F.to_timestamp("run_at")))) / 3_600_000).alias("age_hours"))
