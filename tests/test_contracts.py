import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaywatch.sources import contracts, landing

PLAYER = {
    "event_id": "first", "session_id": "night-7", "user_id": "viewer-3", "timestamp": "2031-02-03T04:05:06.789Z", "event_type": "bitrate_switch", "content_id": "c1", "is_live": False,
    "device": {"type": "mobile", "model": "Kite 9", "os": "kiteOS", "app_version": "0.3"}, "geo": {"region": "north", "state": "fjord", "city": "Ostby", "isp": "wire"},
    "cdn": "cdn-c", "bitrate_kbps": 2450, "buffer_length_ms": 730, "playhead_position_s": 61, "error_code": None,
}
V2 = PLAYER | {"event_id": "second", "schema_version": "v2", "network_type": "ethernet"}


def meta():
    return {"_ingested_at": F.current_timestamp(), "_kafka_partition": F.lit(0), "_kafka_offset": F.lit(1)}


def lines(tmp_path, *records):
    path = tmp_path / "in.jsonl"
    path.write_text("\n\n".join(r if isinstance(r, str) else json.dumps(r) for r in records) + "\n")
    return str(path)


def test_flatten(spark, tmp_path):
    df = landing.read_jsonl(spark, lines(tmp_path, PLAYER, V2), contracts.PLAYER_V2)
    rows = {r.event_id: r for r in landing.flatten_player(df.withColumns(meta())).collect()}
    one, two = rows["first"], rows["second"]
    assert len(one) == 26
    assert (one.device_type, one.geo_city, one.event_hour, one.event_time.microsecond) == ("mobile", "Ostby", "2031-02-03T04", 789000)
    assert (one.network_type, two.network_type, two.schema_version) == (None, "ethernet", "v2")


def test_version_1_schema_lands_with_null_version_2_fields(spark, tmp_path):
    df = landing.read_jsonl(spark, lines(tmp_path, PLAYER), contracts.PLAYER_V1)
    row = landing.flatten_player(df.withColumns(meta())).first()
    assert row.network_type is None and row.schema_version is None


def test_strict_and_loose_reading(spark, tmp_path):
    path = lines(tmp_path, PLAYER, "{broken")
    assert landing.read_jsonl(spark, path, contracts.PLAYER_V2, strict=False).select("event_id").collect()[0][0] == "first"
    with pytest.raises(Exception):
        landing.read_jsonl(spark, path, contracts.PLAYER_V2).collect()
    raw = spark.createDataFrame([(json.dumps(PLAYER),), ("{broken",)], "value string").withColumns(meta())
    assert landing.decode(raw, contracts.PLAYER_V2, strict=False).count() == 1
    with pytest.raises(Exception):
        landing.decode(raw, contracts.PLAYER_V2, strict=True).collect()


def test_readers_of_either_version(spark, tmp_path):
    v1, v2 = contracts.CONTRACTS["player_events"]
    old = landing.read_jsonl(spark, lines(tmp_path, PLAYER), contracts.PLAYER_V1)
    row = contracts.read_as(old, v2).first()
    assert (row.network_type, row.schema_version) == ("unknown", "v1")
    new = landing.read_jsonl(spark, lines(tmp_path, V2), contracts.PLAYER_V2)
    assert "network_type" not in contracts.read_as(new, v1).columns


def test_registry_is_backward_compatible_and_idempotent():
    r = contracts.Registry()
    assert r.bootstrap() == {"player_events-value": 2, "scte35_markers-value": 1, "content_metadata-value": 1} == r.bootstrap()
    worse = contracts.Contract(T.StructType([*contracts.PLAYER_V2.fields, T.StructField("must", T.StringType())]))
    with pytest.raises(contracts.Incompatible, match="must"):
        r.register("player_events", worse)
    changed = contracts.Contract(T.StructType([T.StructField(f.name, T.StringType()) if f.name == "bitrate_kbps" else f for f in contracts.PLAYER_V2]), contracts.CONTRACTS["player_events"][1].defaults)
    with pytest.raises(contracts.Incompatible, match="bitrate_kbps"):
        r.register("player_events", changed)


def test_a_value_out_of_its_domain_is_refused(spark, tmp_path):
    df = landing.read_jsonl(spark, lines(tmp_path, V2, V2 | {"network_type": "pigeon"}), contracts.PLAYER_V2)
    with pytest.raises(Exception, match="domain"):
        landing.publish(df, str(tmp_path / "out"))


def test_round_trip_by_version(spark, tmp_path):
    df = landing.read_jsonl(spark, lines(tmp_path, PLAYER, V2), contracts.PLAYER_V2)
    landing.publish(df.withColumn("schema_version", F.coalesce("schema_version", F.lit("v1"))), str(tmp_path / "out"))
    texts = sorted(r[0] for r in spark.read.text(str(tmp_path / "out")).collect())
    assert [("network_type" in t, "schema_version" in t) for t in texts] == [(False, False), (True, True)]  # the version is chosen by record
    assert landing.read_jsonl(spark, str(tmp_path / "out"), contracts.PLAYER_V2).orderBy("event_id").collect() == df.orderBy("event_id").collect()


def test_timeline_and_missing_ads(spark, tmp_path):
    players = landing.read_jsonl(spark, lines(tmp_path, PLAYER, V2 | {"timestamp": "2031-02-03T04:05:00Z"}), contracts.PLAYER_V2)
    marker = spark.createDataFrame([("m", "ch", "splice_insert", 1, True, 1, "2031-02-03T04:05:02Z", 30, "commercial")], contracts.MARKER)
    assert [r.topic for r in landing.timeline(players, marker).collect()] == ["player_events", "scte35_markers", "player_events"]
    assert landing.read_ads(spark, str(tmp_path / "nowhere")).columns == contracts.AD_DECISION.names
