"""Queries that run what has files, tables, contracts or streams on its way: landing, sinks, the speed layer as a stream.

Each writes below the shared folder and returns what it reads back.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaywatch.operators import scratch, sinks, staging
from quaywatch.plans import alerts, batch, checks, marts, serving, speed
from quaywatch.sources import contracts, fixtures, landing
from quaywatch.streaming import replay, state, windows

DELAY_S = 40
SLICE_S = 300
META = ("_ingested_at", "_kafka_partition", "_kafka_offset")


def _wire(spark: SparkSession, d: str) -> DataFrame:
    return landing.decode(fixtures.player_wire(spark, d), contracts.PLAYER_V2, strict=True)


def _ntz(df: DataFrame) -> DataFrame:
    """Times as the fixtures and the SQL have them, without a zone; the session's is UTC."""
    return df.select(*(F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name) for f in df.schema))


# Landing.


def flatten_player(spark: SparkSession, d: str) -> DataFrame:
    return _ntz(landing.flatten_player(_wire(spark, d)))


def flatten_markers(spark: SparkSession, d: str) -> DataFrame:
    return _ntz(landing.flatten_markers(landing.decode(fixtures.markers_wire(spark, d), contracts.MARKER, strict=True)))


def flatten_content(spark: SparkSession, d: str) -> DataFrame:
    rows = landing.flatten_content(landing.decode(fixtures.content_wire(spark, d), contracts.CONTENT, strict=True))
    return rows.select("content_id", "title", "genre", "is_premium", "updated_at", "language", "_kafka_offset")


def decode_loose(spark: SparkSession, d: str) -> DataFrame:
    """Every fiftieth message is cut short, and dropped."""
    raw = fixtures.player_wire(spark, d).withColumn("value", F.when(F.col("_kafka_offset") % 50 == 0, F.substring("value", 1, 20)).otherwise(F.col("value")))
    return landing.decode(raw, contracts.PLAYER_V2, strict=False).groupBy("session_id").agg(F.count("*").alias("events"))


def publish_and_read(spark: SparkSession, d: str) -> DataFrame:
    """Records as JSON lines, by session, each in its version; then read strictly."""
    path = scratch.folder(spark, "published")
    landing.publish(_wire(spark, d).drop(*META), path)
    back = landing.read_jsonl(spark, path, contracts.PLAYER_V2)
    return back.groupBy("event_id", "timestamp", "schema_version", "network_type").agg(F.count("*").alias("copies"))


def ad_feed(spark: SparkSession, d: str) -> DataFrame:
    """A feed that is there, and one that is absent, which is empty with all columns."""
    path = scratch.folder(spark, "ads")
    fixtures.ads(spark, d).write.json(path)
    sold = lambda feed, at: landing.read_ads(spark, at).groupBy(F.lit(feed).alias("feed")).agg(F.count("*").alias("decisions"), F.sum("price_cpm_brl").cast("double").alias("cpm"), F.count("served_ts").alias("served"))
    there, gone = sold("there", path), landing.read_ads(spark, f"{path}-absent")
    return there.unionByName(gone.agg(F.lit("absent").alias("feed"), F.count("*").alias("decisions"), F.sum("price_cpm_brl").cast("double").alias("cpm"), F.count("served_ts").alias("served")))


def _replayed(spark: SparkSession, d: str, messages: DataFrame) -> str:
    """The messages (at, topic, key, value), replayed without waiting."""
    path = scratch.folder(spark, "replayed")
    replay.replay(messages, path, speed=1e12, slice_s=SLICE_S)
    return path


def replay_slices(spark: SparkSession, d: str) -> DataFrame:
    """Both feeds in one order of time, replayed by slices; in_order: whether each file's lines are."""
    markers = landing.decode(fixtures.markers_wire(spark, d), contracts.MARKER, strict=True).drop(*META)
    path = _replayed(spark, d, landing.timeline(_wire(spark, d).drop(*META), markers))
    lines = None
    for topic, at in (("player_events", "timestamp"), ("scte35_markers", "wallclock")):
        one = spark.read.text(f"{path}/{topic}").select(F.lit(topic).alias("topic"), F.regexp_extract(F.input_file_name(), r"slice-(\d+)", 1).cast("long").alias("slice"), F.get_json_object("value", f"$.{at}").alias("at"), F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("line"))
        lines = one if lines is None else lines.unionByName(one)
    before = F.lag("at").over(Window.partitionBy("file").orderBy("line"))
    return lines.withColumn("ordered", F.coalesce(before <= F.col("at"), F.lit(True))).groupBy("topic", "slice").agg(F.count("*").alias("messages"), F.bool_and("ordered").alias("in_order"))


# Contracts.


def read_as_versions(spark: SparkSession, d: str) -> DataFrame:
    """A version 2 reader over version 1 records, and the reverse."""
    v1, v2 = contracts.CONTRACTS["player_events"]
    raw = fixtures.player_wire(spark, d)
    new = contracts.read_as(landing.decode(raw, contracts.PLAYER_V1, strict=True), v2)
    old = contracts.read_as(landing.decode(raw, contracts.PLAYER_V2, strict=True), v1)
    one = new.groupBy(F.lit("v2 reads v1").alias("reader"), "network_type", "schema_version").agg(F.count("*").alias("records"))
    two = old.groupBy(F.lit("v1 reads v2").alias("reader")).agg(F.count("*").alias("records")).withColumns({n: F.lit(n if n in old.columns else None).cast("string") for n in ("network_type", "schema_version")})
    return one.unionByName(two)


def out_of_domain(spark: SparkSession, d: str) -> DataFrame:
    """Of records with a few odd values, those that a writer refuses."""
    odd = _wire(spark, d).withColumns({
        "event_type": F.when(F.col("_kafka_offset") % 40 == 0, "odd").otherwise(F.col("event_type")),
        "network_type": F.when(F.col("_kafka_offset") % 30 == 0, "pigeon").otherwise(F.col("network_type")),
    })
    return odd.where(contracts.out_of_domain(contracts.CONTRACTS["player_events"][1])).groupBy("event_type", "network_type").agg(F.count("*").alias("refused"))


def registered_contracts(spark: SparkSession, d: str) -> DataFrame:
    """Subjects with their versions, registered twice over, and why incompatible ones are refused."""
    registry = contracts.Registry()
    registry.bootstrap()
    rows = [(s, v, None) for s, v in registry.bootstrap().items()]
    newest = contracts.CONTRACTS["player_events"][-1]
    worse = {
        "a field without a default": contracts.Contract(T.StructType([*newest.schema.fields, T.StructField("must", T.StringType())]), newest.defaults, newest.domains),
        "another type": contracts.Contract(T.StructType([T.StructField(f.name, T.StringType()) if f.name == "bitrate_kbps" else f for f in newest.schema]), newest.defaults, newest.domains),
        "a narrower domain": contracts.Contract(newest.schema, newest.defaults, newest.domains | {"event_type": ("heartbeat",)}),
    }
    for what, contract in worse.items():
        try:
            registry.register("player_events", contract)
        except contracts.Incompatible as fault:
            rows.append((what, 0, str(fault).split(": ")[1]))
    return spark.createDataFrame(rows, "subject string, version int, fault string")


# Tables.


def bronze_overwrite(spark: SparkSession, d: str) -> DataFrame:
    """A landed table written twice, the second time with fewer partitions, then with nothing; partition values are text."""
    path = scratch.folder(spark, "bronze")
    rows = fixtures.player(spark, d).withColumn("part", F.date_format("event_time", "yyyy-MM-dd'T'HH-mm"))
    sinks.overwrite(rows, path, ["part"])
    sinks.overwrite(rows.where("session_id <> 's1' and minute(event_time) < 10"), path, ["part"])
    sinks.overwrite(rows.where("false"), path, ["part"])
    return sinks.read(spark, path).groupBy("part").agg(F.count("*").alias("events")).withColumn("version", F.lit(sinks.version(spark, path)))


def upsert_windows(spark: SparkSession, d: str) -> DataFrame:
    """Windows without a marker, whose column has no type yet; then some again with one event more and a marker."""
    path, keys = scratch.folder(spark, "upserted"), ["session_id", "window_start"]
    rows = speed.windows(_staged(spark, d)).select(*keys, "window_bucket", "events").persist()
    sinks.upsert(rows.withColumn("marker_id", F.lit(None)), path, keys, ["window_bucket"], {"marker_id": "string"})
    again = rows.where("minute(window_start) < 12 and substring(session_id, 2) % 5 = 0")
    sinks.upsert(again.withColumns({"events": F.col("events") + 1, "marker_id": F.lit("m")}), path, keys, ["window_bucket"], {"marker_id": "string"})
    rows.unpersist()
    return sinks.read(spark, path)


def compacted_table(spark: SparkSession, d: str) -> DataFrame:
    """Windows appended in six pieces, compacted and vacuumed: rows and files of each partition."""
    path = scratch.folder(spark, "appended")
    rows = speed.windows(_staged(spark, d)).select("session_id", "window_start", "window_bucket", "events").persist()
    for k in range(6):
        sinks.append(rows.where(F.pmod(F.substring("session_id", 2, 20).cast("long"), F.lit(6)) == k).coalesce(1), path, ["window_bucket"])
    rows.unpersist()
    sinks.compact(spark, path, ["window_bucket"])
    sinks.vacuum(spark, path)
    files = spark.createDataFrame([(f.rpartition("window_bucket=")[2].split("/")[0], 1) for f, _ in sinks.files(spark, path)], "window_bucket string, files int")
    held = sinks.read(spark, path).groupBy("window_bucket").agg(F.count("*").alias("windows"), F.sum("events").alias("events"))
    return held.join(files.groupBy("window_bucket").agg(F.count("*").alias("files")), "window_bucket", "left")


def batch_run(spark: SparkSession, d: str) -> DataFrame:
    """All feeds landed, all marts rebuilt, checked, exported and recorded: what the manifest and the exported marts hold."""
    bronze, gold, ads = (scratch.folder(spark, n) for n in ("bronze", "gold", "ads"))
    wire = {"player_events": (fixtures.player_wire, contracts.PLAYER_V2), "scte35_markers": (fixtures.markers_wire, contracts.MARKER), "content_metadata": (fixtures.content_wire, contracts.CONTENT)}
    batch.land({topic: landing.decode(f(spark, d), schema, strict=True) for topic, (f, schema) in wire.items()}, bronze)
    fixtures.ads(spark, d).write.json(ads)
    batch.rebuild(spark, bronze, ads, gold)
    names = ("session_window_qoe", "ccv", "ad_impact", "ad_creatives")
    batch.bind(spark, {f"gold_{n}": sinks.read(spark, f"{gold}/{n}") for n in names})
    held = spark.sql(" UNION ALL ".join(f"SELECT '{n}' AS mart, count(*) AS exported FROM gold_{n}" for n in names))
    run = sinks.runs(spark, gold).select("bronze_player_version", F.explode("rows").alias("mart", "n_rows"))
    return run.join(held, "mart").select("mart", "n_rows", "exported", F.col("bronze_player_version").alias("bronze_version"))


def table_catalog(spark: SparkSession, d: str) -> DataFrame:
    """Which tables are there, in which version, and with which columns."""
    top = scratch.folder(spark, "catalog")
    sinks.overwrite(fixtures.markers(spark, d), f"{top}/markers")
    sinks.append(fixtures.markers(spark, d), f"{top}/markers")
    rows = []
    for name in ("markers", "absent"):
        path = f"{top}/{name}"
        there = sinks.has_table(spark, path)
        rows.append((name, there, sinks.version(spark, path), there and "break_type" in sinks.read(spark, path).columns, sinks.exists(spark, f"{path}/none")))
    return spark.createDataFrame(rows, "name string, present boolean, version int, has_break_type boolean, none boolean")


def absent_marts(spark: SparkSession, d: str) -> DataFrame:
    """What each panel shows of a store without marts: nothing."""
    held = serving.load(spark, scratch.folder(spark, "no-gold"))
    panels = {
        "ccv_by_region": serving.ccv_by_region(held["ccv"]), "qoe_by_network_type": serving.qoe_by_network_type(held["session_window_qoe"]), "ad_impact": serving.ad_impact(held["ad_impact"]), "ad_creatives": serving.ad_creatives(held["ad_creatives"]),
        "rebuffering_by_cdn": serving.rebuffering_by_cdn(held["speed"]), "unique_views_per_minute": serving.unique_views_per_minute(held["speed"]), "avg_bitrate_by_cdn": serving.avg_bitrate_by_cdn(held["speed"]),
        "known_cdns": serving.known_cdns(held["speed"]), "current_alerts": serving.current_alerts(held["alerts"]), "cdn_health": serving.cdn_health(held["speed"], held["alerts"]),
    }
    out = None
    for name, df in panels.items():
        one = df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("panel"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


def display_order(spark: SparkSession, d: str) -> DataFrame:
    """Regions as they are shown; there are as many rows as regions."""
    rows = serving.ordered(serving.ccv_by_region(marts.ccv(_mart(spark, d)))).collect()
    return spark.createDataFrame([(k + 1, *r) for k, r in enumerate(rows)], "place int, region string, peak_ccv long, avg_ccv double")


def gold_checksum_ordered(spark: SparkSession, d: str) -> DataFrame:
    mart = _mart(spark, d)
    return spark.createDataFrame([(marts.ordered_checksum(mart),)], "qoe_checksum string")


# Service levels.


def error_alert_transitions(spark: SparkSession, d: str) -> DataFrame:
    return alerts.error_transitions(speed.windows(_staged(spark, d)))


def error_slo_ticket(spark: SparkSession, d: str) -> DataFrame:
    """Transitions of the error alert with a budget a tenth as large, so that there are some."""
    return alerts.error_transitions(speed.windows(_staged(spark, d)), alerts.BurnRate(budget=0.001))


def watermark_lag(spark: SparkSession, d: str) -> DataFrame:
    """The watermark trails the latest event of earlier batches by its delay; a batch is a slice of arrivals."""
    arrived = fixtures.player(spark, d).groupBy(F.floor(F.unix_timestamp(F.col("_ingested_at").cast("timestamp")) / SLICE_S).alias("slice")).agg(F.max("event_time").alias("max_event_time"))
    before = F.max("max_event_time").over(Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))
    progress = arrived.withColumn("watermark", before - F.expr(f"INTERVAL {DELAY_S} SECONDS")).where("watermark is not null")
    return checks.watermark_lag_p95(progress)


def mart_age(spark: SparkSession, d: str) -> DataFrame:
    path = scratch.folder(spark, "manifest")
    for at in ("2024-01-01T00:00:00+00:00", "2024-01-02T12:00:00+00:00"):
        sinks.add_run(spark, path, {"run_at": at, "bronze_player_version": 1, "rows": {}, "qoe_checksum": ""})
    return checks.mart_age_hours(sinks.runs(spark, path), F.lit("2024-01-03T06:30:00+00:00").cast("timestamp"))


# Streams.


def _staged(spark: SparkSession, d: str) -> DataFrame:
    return staging.player_events(fixtures.player(spark, d))


def _mart(spark: SparkSession, d: str) -> DataFrame:
    return marts.session_window_qoe(_staged(spark, d), staging.latest_content(fixtures.content(spark, d)))


def _arrivals(spark: SparkSession, d: str) -> str:
    """The player feed replayed in the order of its arrival, and a last event that closes all windows; a file is a batch of the stream."""
    wire = fixtures.player_wire(spark, d)
    rows = wire.select(F.col("_ingested_at").cast("timestamp").alias("at"), F.lit("player_events").alias("topic"), F.lpad(F.col("_kafka_offset").cast("string"), 20, "0").alias("key"), "value")
    end = spark.range(1).select(F.lit("2030-01-01 00:00:00").cast("timestamp").alias("at"), F.lit("player_events").alias("topic"), F.lit("end").alias("key"), F.lit('{"event_id": "end", "session_id": "end", "timestamp": "2030-01-01T00:00:00.000Z", "event_type": "seek"}').alias("value"))
    return f"{_replayed(spark, d, rows.unionByName(end))}/player_events"


def _stream(spark: SparkSession, d: str) -> DataFrame:
    return landing.stream_jsonl(spark, _arrivals(spark, d), contracts.PLAYER_V2, files_per_trigger=1)


def _drained(df: DataFrame, name: str) -> DataFrame:
    """The stream's rows, once it has read all that is there."""
    spark, path = df.sparkSession, scratch.folder(df.sparkSession, name)
    query = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{path}-state").trigger(availableNow=True).start(path)
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


def stream_windows(spark: SparkSession, d: str) -> DataFrame:
    """The speed layer as a stream: decoded, deduplicated, windowed, finalised."""
    return _drained(windows.windows(windows.decoded(_stream(spark, d)), delay=f"{DELAY_S} seconds"), "stream-windows").where("session_id <> 'end'")


def stream_markers(spark: SparkSession, d: str) -> DataFrame:
    """The stream's windows appended to a table, with markers that are read anew for each batch, and deduplicated on read."""
    path = scratch.folder(spark, "silver")
    rows = windows.windows(windows.decoded(_stream(spark, d)), delay=f"{DELAY_S} seconds")
    windows.to_table(rows, path, f"{path}-state", markers=lambda: fixtures.markers(spark, d)).awaitTermination()
    held = staging.dedupe_on_read(sinks.read(spark, path).where("session_id <> 'end'"))
    return held.select("session_id", "window_start", "marker_id", "break_type", "scte_event_id")


def stream_upserts(spark: SparkSession, d: str) -> DataFrame:
    """The stream's windows upserted twice over: the same windows."""
    path, folder = scratch.folder(spark, "silver-upserts"), _arrivals(spark, d)
    for again in "ab":
        rows = windows.windows(windows.decoded(landing.stream_jsonl(spark, folder, contracts.PLAYER_V2)), delay=f"{DELAY_S} seconds")
        windows.upsert_to_table(rows, path, f"{path}-state-{again}").awaitTermination()
    return sinks.read(spark, path).where("session_id <> 'end'").groupBy("window_bucket").agg(F.count("*").alias("windows"), F.sum("events").alias("events"))


def stream_alerts(spark: SparkSession, d: str) -> DataFrame:
    """Alerts as keyed state over the stream's windows, appended to a table."""
    path = scratch.folder(spark, "alerts")
    rows = windows.windows(windows.decoded(_stream(spark, d)), delay=f"{DELAY_S} seconds")
    with state.rocksdb(spark):
        query = state.alerts_to_table(rows, path, f"{path}-state")
    query.awaitTermination()
    return spark.read.parquet(path).where("cdn <> 'unknown'").drop("processed_at")


def stream_bounded_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """First copies within three minutes, by session, in the order of the lines in the files."""
    lines = landing.stream_jsonl(spark, _arrivals(spark, d), contracts.PLAYER_V2, files_per_trigger=1, arrival=True)
    events = windows.decoded(lines).select("event_id", "session_id", "event_time", *landing.ARRIVAL)
    with state.rocksdb(spark):
        kept = _drained(state.bounded_dedupe(events, arrival=landing.ARRIVAL), "bounded")
    return kept.where("session_id <> 'end'").groupBy("session_id").agg(F.count("*").alias("events"), F.count_distinct("event_id").alias("ids"))


def stream_late_rows(spark: SparkSession, d: str) -> DataFrame:
    """Events more than three seconds behind the latest one of earlier batches."""
    path = scratch.folder(spark, "late")
    windows.late_to_table(windows.decoded(_stream(spark, d)).select("event_id", "session_id", "event_time"), path, f"{path}-state", delay_s=3).awaitTermination()
    return spark.read.schema("event_id string, session_id string, event_time timestamp").parquet(path).groupBy("event_id", "session_id").agg(F.count("*").alias("copies"))


def stream_late_share(spark: SparkSession, d: str) -> DataFrame:
    """An event for each region, a batch each, of which the last is long past: the share that the watermark drops, and what a tap has counted."""
    after = F.element_at(F.array(*(F.lit(x) for x in (0, 10, 200, 300, 5))), F.col("r_regionkey") + 1)
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    iso = F.date_format(start + F.make_dt_interval(secs=after), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    record = F.to_json(F.struct(F.col("r_name").alias("event_id"), F.lit("s").alias("session_id"), iso.alias("timestamp"), F.lit("seek").alias("event_type")))
    rows = spark.read.parquet(f"{d}/region.parquet").select((start + F.make_dt_interval(secs=F.col("r_regionkey") * SLICE_S)).alias("at"), F.lit("player_events").alias("topic"), F.col("r_name").alias("key"), record.alias("value"))
    events = windows.decoded(landing.stream_jsonl(spark, f"{_replayed(spark, d, rows)}/player_events", contracts.PLAYER_V2, files_per_trigger=1))
    path = scratch.folder(spark, "tapped")
    query = windows.windows(replay.tap(events, "events"), dedupe=False).writeStream.format("parquet").option("checkpointLocation", f"{path}-state").trigger(availableNow=True).start(path)
    query.awaitTermination()
    progress = query.recentProgress
    tapped = sum(p.observedMetrics["events"].n for p in progress if "events" in p.observedMetrics)
    return spark.createDataFrame([(tapped, checks.late_share([json.loads(p.json) for p in progress]))], "tapped long, late_share double")


def bounded_drain(spark: SparkSession, d: str) -> DataFrame:
    """All messages that are there when it begins, with what the broker would add, decoded and flattened."""
    path = scratch.folder(spark, "drained")
    landing.drain(landing.stream_messages(spark, _arrivals(spark, d)), path, f"{path}-state")
    rows = landing.flatten_player(landing.decode(sinks.read(spark, path), contracts.PLAYER_V2, strict=True))
    return rows.where("session_id <> 'end'").groupBy("event_type").agg(F.count("*").alias("messages"), F.count("_ingested_at").alias("landed"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            flatten_player, flatten_markers, flatten_content, decode_loose, publish_and_read, ad_feed, replay_slices, read_as_versions, out_of_domain, registered_contracts, bronze_overwrite, upsert_windows, compacted_table,
            batch_run, table_catalog, absent_marts, display_order, gold_checksum_ordered, error_alert_transitions, error_slo_ticket, watermark_lag, mart_age,
            stream_windows, stream_markers, stream_upserts, stream_alerts, stream_bounded_dedupe, stream_late_rows, stream_late_share, bounded_drain,
        )
    }
