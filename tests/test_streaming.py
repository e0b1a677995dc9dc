"""Streams over files, beyond what `flows` holds against SQL: windows, markers, upserts and alerts."""

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quaywatch.sources import contracts, landing
from quaywatch.streaming import replay, state, windows

COLUMNS = ["event_id", "session_id", "event_time", "event_type", "cdn", "bitrate_kbps", "device_type", "geo_region"]


def stream(spark, tmp_path, df, n=6):
    """The rows as a stream of n files in order of arrival, and an event far ahead that closes all windows."""
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    folder = tmp_path / "in"
    folder.mkdir()
    rows = df.orderBy("_ingested_at", "event_id").select(*COLUMNS).toPandas()
    schema = df.select(*(F.col(c).cast("timestamp").alias(c) if c == "event_time" else F.col(c) for c in COLUMNS)).schema
    step = -(-len(rows) // n)
    for k in range(n):
        part = rows.iloc[k * step : (k + 1) * step]
        (folder / f"{k:03d}.json").write_text("\n".join(json.dumps(r | {"event_time": r["event_time"].isoformat() + "Z", "bitrate_kbps": None if r["bitrate_kbps"] != r["bitrate_kbps"] else int(r["bitrate_kbps"])}) for r in part.to_dict("records")))
    (folder / "999.json").write_text(json.dumps({"event_id": "end", "session_id": "end", "event_time": "2030-01-01T00:00:00Z", "event_type": "seek"}))
    for k, path in enumerate(sorted(folder.iterdir())):  # the order in which the stream takes them
        os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder))


def drain(df, name, tmp_path, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / f"cp-{name}")).trigger(availableNow=True).start()
    assert q.awaitTermination(240)
    return df.sparkSession.table(name), q


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    start = datetime(2026, 1, 1)
    rows = [(f"e{k}", "s", start + timedelta(seconds=t), "heartbeat", "cdn-a", 1, "tv", "SE", start + timedelta(seconds=k)) for k, t in enumerate([0, 10, 200, 300, 5])]
    df = spark.createDataFrame(rows, "event_id string, session_id string, event_time timestamp_ntz, event_type string, cdn string, bitrate_kbps int, device_type string, geo_region string, _ingested_at timestamp_ntz")
    seen = replay.Progress()
    spark.streams.addListener(seen)
    got, q = drain(replay.tap(windows.windows(stream(spark, tmp_path, df, n=5), dedupe=False), "windows"), "late_windows", tmp_path)
    assert {r.window_start.minute: r.events for r in got.where("session_id = 's'").collect()} == {0: 2, 3: 1, 5: 1}
    spark.streams.removeListener(seen)
    from quaywatch.plans import checks

    assert checks.late_share([json.loads(p.json) for p in q.recentProgress]) == pytest.approx(1 / 6)


def test_bounded_dedupe(spark, tmp_path):
    state.use_rocksdb(spark)
    start = datetime(2026, 1, 1)
    order = [("a", 0), ("a", 0), ("b", 100), ("c", 300), ("a", 0), ("c", 300)]
    rows = [(e, "s", start + timedelta(seconds=t), "heartbeat", "cdn-a", 1, "tv", "SE", start + timedelta(seconds=k)) for k, (e, t) in enumerate(order)]
    df = spark.createDataFrame(rows, "event_id string, session_id string, event_time timestamp_ntz, event_type string, cdn string, bitrate_kbps int, device_type string, geo_region string, _ingested_at timestamp_ntz")
    got, _ = drain(state.bounded_dedupe(stream(spark, tmp_path, df, n=6)), "bounded", tmp_path)
    # The second copy of a is held back; the third comes when a has left the horizon.
    assert sorted(r.event_id for r in got.where("session_id = 's'").collect()) == ["a", "a", "b", "c"]


def test_bounded_dedupe_takes_lines_in_order_of_arrival(spark, tmp_path):
    """A small file and a later, larger one in one batch: Spark reads the blocks of the larger one first."""
    folder = tmp_path / "in"
    folder.mkdir()
    line = lambda e, t: json.dumps({"event_id": e, "session_id": "s", "timestamp": f"2026-01-01T00:{t // 60:02d}:{t % 60:02d}.000Z", "event_type": "seek", "content_id": "x" * 500}) + "\n"
    (folder / "b.json").write_text(line("e0", 0))
    (folder / "a.json").write_text(line("e0", 0) + "".join(line(f"e{t}", t) * 2 for t in range(1, 300)))
    for k, name in enumerate("ba"):
        os.utime(folder / f"{name}.json", (1_700_000_000 + k, 1_700_000_000 + k))
    small = {"spark.sql.files.maxPartitionBytes": "20000", "spark.sql.files.openCostInBytes": "0", "spark.sql.execution.arrow.maxRecordsPerBatch": "7"}
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        lines = windows.decoded(landing.stream_jsonl(spark, str(folder), contracts.PLAYER_V2, arrival=True)).select("event_id", "session_id", "event_time", *landing.ARRIVAL)
        with state.rocksdb(spark):
            got, _ = drain(state.bounded_dedupe(lines, arrival=landing.ARRIVAL), "in_order", tmp_path)
        assert got.columns == ["event_id", "session_id", "event_time"]
        assert [r.event_id for r in got.collect()] == [f"e{t}" for t in range(300)]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_replay_is_paced_without_drift(spark, tmp_path):
    df = spark.createDataFrame([(datetime(2026, 1, 1, 0, 0, s), "t", "k", json.dumps({"s": s})) for s in (0, 1, 12, 25)], "at timestamp, topic string, key string, value string")
    now, naps = [0.0], []

    def sleep(s):
        naps.append(s)
        now[0] += s + 0.05

    assert replay.replay(df, str(tmp_path / "out"), speed=10, slice_s=10, clock=lambda: now[0], sleep=sleep) == 3
    assert naps == [pytest.approx(1.0), pytest.approx(0.95)]
    assert spark.read.json(str(tmp_path / "out/t")).count() == 4


def test_late_rows_upserts_and_alert_table(spark, tmp_path, sf_dir):
    state.use_rocksdb(spark)
    start = datetime(2026, 1, 1)
    rows = [(f"e{k}", "s", start + timedelta(seconds=t), "heartbeat", "cdn-a", 1, "tv", "SE", start + timedelta(seconds=k)) for k, t in enumerate([0, 10, 200, 195, 5])]
    df = spark.createDataFrame(rows, "event_id string, session_id string, event_time timestamp_ntz, event_type string, cdn string, bitrate_kbps int, device_type string, geo_region string, _ingested_at timestamp_ntz")
    events = stream(spark, tmp_path, df, n=5)
    q = windows.late_to_table(events, str(tmp_path / "late"), str(tmp_path / "cp1"), delay_s=10)
    assert q.awaitTermination(240)
    assert [r.event_id for r in spark.read.parquet(str(tmp_path / "late")).collect()] == ["e4"]
    for again in ("a", "b"):  # the second run writes the same windows once more
        q = windows.upsert_to_table(windows.windows(events, delay="1 hour"), str(tmp_path / "up"), str(tmp_path / f"cp-{again}"))
        assert q.awaitTermination(240)
    assert sorted(r.events for r in spark.read.parquet(str(tmp_path / "up")).where("session_id = 's'").collect()) == [2, 3]
    q = state.alerts_to_table(windows.windows(events), str(tmp_path / "alerts"), str(tmp_path / "cp2"))
    assert q.awaitTermination(240)
    assert spark.read.parquet(str(tmp_path / "alerts")).columns == ["cdn", "state", "tier", "minute", "processed_at"]
