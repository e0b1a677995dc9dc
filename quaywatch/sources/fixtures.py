"""Telemetry tables derived from the driver's tables; one simulated day is one minute.

Times are TIMESTAMP_NTZ in UTC. `oracles.PLAYER` and its neighbours state the
same rules in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


START = "TIMESTAMP_NTZ '2024-01-01 00:00:00'"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _after(ms: Column) -> Column:
    return F.expr(START) + F.make_dt_interval(secs=(ms.cast("decimal(18,3)") / 1000).cast("decimal(18,6)"))


def player(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed player events, with duplicates and late arrivals."""
    regions = _table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    e = _table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    e = e.withColumn("ms", F.expr(f"timestampdiff(MICROSECOND, {START}, ts) div 1440000"))
    minute, user = F.expr("ms div 60000"), F.col("user_id")
    ends = user % 6 != 5
    kind = (
        F.when(F.col("event_type") == "view", "heartbeat")
        .when(F.col("event_type") == "signup", "video_start")
        .when(F.col("event_type") == "purchase", F.when((F.col("k") >= 50) & ends, "video_end").otherwise("bitrate_switch"))
        .when(F.col("event_type") == "error", F.when((F.col("k") < 5) & ends, "error").when(F.col("k") % 2 == 0, "ad_start").otherwise("ad_end"))
        .otherwise("buffer_start")
    )
    gap = F.floor("value").cast("long") * F.when((user % 4 == 1) & minute.between(10, 14), 100).otherwise(1)
    e = e.withColumns({"kind": kind, "gap": gap})
    # A click is a buffer's start, and its end is a row of its own.
    first = F.struct(F.col("kind").alias("t"), F.col("ms").alias("at"), F.lit("").alias("tail"), F.lit(0).cast("long").alias("more"))
    last = F.struct(F.lit("buffer_end").alias("t"), (F.col("ms") + F.col("gap")).alias("at"), F.lit("-end").alias("tail"), F.lit(1).cast("long").alias("more"))
    e = e.withColumn("r", F.explode(F.when(F.col("kind") == "buffer_start", F.array(first, last)).otherwise(F.array(first))))
    e = e.withColumn("again", F.explode(F.when(F.col("event_id") % 100 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    k, event_time = F.col("k"), _after(F.col("r.at"))
    newer = F.when(k == 7, "cellular").when(k == 8, "wifi").when(k == 9, "ethernet")
    return e.join(regions, user % 5 == F.col("r_regionkey")).select(
        F.concat(F.lit("e"), "event_id", "r.tail").alias("event_id"), F.concat(F.lit("s"), user).alias("session_id"), F.concat(F.lit("u"), user).alias("user_id"),
        event_time.alias("event_time"), F.col("r.t").alias("event_type"), F.concat(F.lit("c"), user % 20).alias("content_id"), F.lit(True).alias("is_live"),
        F.element_at(F.array(F.lit("smart_tv"), F.lit("mobile"), F.lit("web")), (user % 3 + 1).cast("int")).alias("device_type"),
        *(F.lit(v).alias(n) for n, v in (("device_model", "m"), ("device_os", "os"), ("app_version", "1"))),
        F.col("r_name").alias("geo_region"), *(F.lit(v).alias(n) for n, v in (("geo_state", "st"), ("geo_city", "ci"), ("geo_isp", "isp"))),
        F.element_at(F.array(*(F.lit(f"cdn-{c}") for c in "abcd")), (user % 4 + 1).cast("int")).alias("cdn"),
        F.when(k == 99, 0).otherwise(1000 + 50 * k).alias("bitrate_kbps"), (100 * k).alias("buffer_length_ms"), F.expr("cast(r.at div 1000 as int)").alias("playhead_position_s"),
        F.when(F.col("r.t") == "error", F.concat(F.lit("E"), k)).alias("error_code"), F.when(newer.isNotNull(), "v2").alias("schema_version"), newer.alias("network_type"),
        F.date_format(event_time, "yyyy-MM-dd'T'HH").alias("event_hour"), _after(F.col("r.at") + F.col("event_id") % 16 * 1000 + F.col("again") * 1000).alias("_ingested_at"),
        (user % 6).cast("int").alias("_kafka_partition"), (2 * F.col("event_id") + F.col("r.more") + F.col("again").cast("long") * 1_000_000_000).alias("_kafka_offset"),
    )


def _iso(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def player_wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The player events as messages: value, a nested record in JSON, and what the broker adds."""
    device = F.struct(F.col("device_type").alias("type"), F.col("device_model").alias("model"), F.col("device_os").alias("os"), "app_version")
    geo = F.struct(*(F.col(f"geo_{n}").alias(n) for n in ("region", "state", "city", "isp")))
    record = F.struct(
        "event_id", "session_id", "user_id", _iso("event_time").alias("timestamp"), "event_type", "content_id", "is_live", device.alias("device"), geo.alias("geo"), "cdn",
        "bitrate_kbps", "buffer_length_ms", "playhead_position_s", "error_code", "schema_version", "network_type",
    )
    return player(spark, sf_dir).select(F.to_json(record).alias("value"), "_ingested_at", "_kafka_partition", "_kafka_offset")


def _messages(rows: DataFrame, offset: Column) -> DataFrame:
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("value"), F.expr(START).alias("_ingested_at"), F.lit(0).alias("_kafka_partition"), offset.cast("long").alias("_kafka_offset"))


def markers_wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _messages(markers(spark, sf_dir).withColumn("wallclock", _iso("wallclock")), F.col("event_id_scte") - 1000)


def content_wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _messages(content(spark, sf_dir), F.substring("content_id", 2, 20).cast("long"))


def markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey")
    return _table(spark, sf_dir, "nation").select(
        F.concat(F.lit("m"), n).alias("marker_id"), F.lit("ch").alias("channel"), F.lit("splice_insert").alias("splice_command"), (1000 + n).alias("event_id_scte"), F.lit(True).alias("out_of_network"),
        (n.cast("long") * 90000).alias("pts_time"), _after((72 * n + 15).cast("long") * 1000).alias("wallclock"), F.when(n % 2 == 0, 30).otherwise(60).alias("duration_s"),
        F.when(n % 5 == 4, "program_boundary").when(n % 5 == 3, "blackout").otherwise("commercial").alias("break_type"),
    )


def content(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    versions = F.when(key % 2 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    p = _table(spark, sf_dir, "part").withColumn("v", F.explode(versions))
    return p.select(
        F.concat(F.lit("c"), key).alias("content_id"), F.concat("p_name", F.when(F.col("v") == 2, " (rev)").otherwise("")).alias("title"), F.col("p_type").alias("genre"), (F.col("p_size") > 25).alias("is_premium"),
        F.when(F.col("v") == 2, "2023-12-15").otherwise("2023-12-01").alias("updated_at"),
    )


def ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    return _table(spark, sf_dir, "orders").select(
        F.concat(F.lit("d"), o).alias("decision_id"), (1000 + o % 27).cast("int").alias("event_id_scte"), F.concat(F.lit("adv"), c % 10).alias("advertiser_id"), F.concat(F.lit("Advertiser "), c % 10).alias("advertiser_name"),
        F.concat(F.lit("cr"), c % 30).alias("creative_id"), F.when(o % 2 == 0, 15).otherwise(30).alias("creative_duration_s"), (o % 4).cast("int").alias("slot_index"),
        (F.floor(F.col("o_totalprice") / 100 + 0.5).cast("decimal(12,0)") / 100).cast("decimal(10,2)").alias("price_cpm_brl"),
    )
