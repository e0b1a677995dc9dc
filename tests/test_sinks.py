import json

import pytest
from pyspark.sql import functions as F

from quaywatch.operators import sinks
from quaywatch.plans import batch, checks, marts
from quaywatch.queries import staged
from quaywatch.sources import contracts, fixtures
from test_contracts import PLAYER

HINTS = {"marker_id": "string", "scte_event_id": "bigint"}


def rows(spark, *data):
    return spark.createDataFrame(data, "session_id string, window_start string, window_bucket string, events int, marker_id string, scte_event_id long")


def test_all_null_columns_of_a_first_batch_keep_their_types(spark, tmp_path):
    path = str(tmp_path / "t")
    first = rows(spark, ("s1", "w1", "b1", 1, None, None)).withColumns({"marker_id": F.lit(None), "scte_event_id": F.lit(None)})
    sinks.upsert(first, path, ["session_id", "window_start"], ["window_bucket"], HINTS)
    sinks.upsert(rows(spark, ("s2", "w1", "b1", 2, "m", 7)), path, ["session_id", "window_start"], ["window_bucket"], HINTS)
    got = sinks.read(spark, path)
    assert dict(got.dtypes)["scte_event_id"] == "bigint" and dict(got.dtypes)["marker_id"] == "string"
    assert got.count() == 2


def test_upsert_replaces_adds_and_leaves_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    keys = ["session_id", "window_start"]
    sinks.upsert(rows(spark, ("s1", "w1", "b1", 1, None, None), ("s2", "w1", "b1", 1, None, None), ("s1", "w9", "b2", 1, None, None)), path, keys, ["window_bucket"])
    other = [f for f in sinks.files(spark, path) if "window_bucket=b2" in f[0]]
    sinks.upsert(rows(spark, ("s1", "w1", "b1", 5, "m", 1), ("s3", "w1", "b1", 6, "m", 1)), path, keys, ["window_bucket"])
    assert sorted((r.session_id, r.window_start, r.events) for r in sinks.read(spark, path).collect()) == [("s1", "w1", 5), ("s1", "w9", 1), ("s2", "w1", 1), ("s3", "w1", 6)]
    assert [f for f in sinks.files(spark, path) if "window_bucket=b2" in f[0]] == other
    assert sinks.version(spark, path) == 2


def test_overwrite_and_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.read(spark, path, contracts.MARKER).count() == 0
    df = rows(spark, ("s1", "w1", "2026-05-20T22", 1, None, None), ("s2", "w1", "b2", 1, None, None))
    assert sinks.overwrite(df.where("false"), path) == 0 and not sinks.has_table(spark, path)
    assert sinks.overwrite(df, path, ["window_bucket"]) == 1
    assert sinks.overwrite(df.where("session_id = 's1'"), path, ["window_bucket"]) == 2
    assert [(r.session_id, r.window_bucket) for r in sinks.read(spark, path).collect()] == [("s1", "2026-05-20T22")]


def test_compaction(spark, tmp_path):
    path = str(tmp_path / "t")
    for k in range(5):
        sinks.append(rows(spark, (f"s{k}", "w", "b1", k, None, None), (f"s{k}", "w", "b2", k, None, None)), path, ["window_bucket"])
    sinks.append(rows(spark, ("alone", "w", "b 3=%", 1, None, None), ("none", "w", None, 1, None, None)), path, ["window_bucket"])
    alone = [f for f in sinks.files(spark, path) if "bucket=b1" not in f[0] and "bucket=b2" not in f[0]]
    before, after = sinks.compact(spark, path, ["window_bucket"])
    assert before == 12 and after == 4 and len(alone) == 2 and set(alone) <= set(sinks.files(spark, path))
    assert sinks.read(spark, path).count() == 12 and sinks.read(spark, path).where("window_bucket = 'b 3=%'").count() == 1
    assert sinks.compact(spark, path, ["window_bucket"]) == (4, 4)
    (tmp_path / "t-staged-x").mkdir()
    assert sinks.vacuum(spark, path, retain_hours=1) == 1  # the replaced folders stay for an hour
    assert sinks.vacuum(spark, path) == 1 and sinks.read(spark, path).count() == 12
    assert sinks.compact(spark, str(tmp_path / "absent"), ["x"]) == (0, 0)


def test_compaction_reaches_its_target_in_a_large_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 256).alias("x"), F.when(F.col("id") % 100 == 0, "small").otherwise("large").alias("p"))
    sinks.append(df.repartition(30), path, ["p"])
    size = sum(s for f, s in sinks.files(spark, path) if "p=large" in f)
    target = size // 5
    sinks.compact(spark, path, ["p"], target)
    sizes = [s for f, s in sinks.files(spark, path) if "p=large" in f]
    assert len(sizes) == 5 and max(sizes) < 1.5 * target and len([f for f, _ in sinks.files(spark, path) if "p=small" in f]) == 1
    assert sinks.read(spark, path).select("x", "p").exceptAll(df).isEmpty() and sinks.read(spark, path).count() == 200_000
    flat = str(tmp_path / "flat")
    sinks.append(df.repartition(7), flat)
    assert sinks.compact(spark, flat, []) == (7, 1) and sinks.read(spark, flat).count() == 200_000


@pytest.mark.parametrize("lost", range(1, 6))
def test_a_crash_between_the_steps_of_an_overwrite(spark, tmp_path, monkeypatch, lost):
    """The move or deletion number `lost` never happens; the next reader finds the new table whole, and once."""
    path, steps = str(tmp_path / "t"), []
    old = rows(spark, ("s1", "w1", "b1", 1, None, None), ("s2", "w1", "b2", 1, None, None))
    new = rows(spark, ("s1", "w1", "b1", 2, None, None))
    sinks.overwrite(old, path, ["window_bucket"])

    def failing(work):
        def step(*args):
            steps.append(1)
            if len(steps) >= lost:
                raise OSError("lost")
            return work(*args)

        return step

    with monkeypatch.context() as m:
        for name in ("move", "_commit", "remove"):
            m.setattr(sinks, name, failing(getattr(sinks, name)))
        with pytest.raises(OSError):
            sinks.overwrite(new, path, ["window_bucket"])
    assert sinks.has_table(spark, path)
    assert [(r.session_id, r.events) for r in sinks.read(spark, path).collect()] == [("s1", 2)]
    sinks.upsert(rows(spark, ("s1", "w1", "b1", 3, None, None)), path, ["session_id", "window_start"], ["window_bucket"])
    assert [(r.session_id, r.events) for r in sinks.read(spark, path).collect()] == [("s1", 3)]


def test_reading_leaves_the_session_as_it_was(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "2031-02-03")], "x int, day string")
    sinks.overwrite(df, path, ["day"])
    table = sinks.read(spark, path)
    assert dict(spark.read.parquet(path).dtypes)["day"] == "date"  # what others read keeps its inferred type
    assert dict(table.dtypes)["day"] == "string" and table.first().day == "2031-02-03"


def test_two_writers_take_different_numbers(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1,)], "x int")
    assert sinks.append(df, path) == 1
    monkeypatch.setattr(sinks, "version", lambda *_: 0)  # a writer that looked before the other's commit
    assert sinks.append(df, path) == 2


def test_land_and_rebuild_twice(spark, tmp_path):
    path = tmp_path / "raw.jsonl"
    events = [PLAYER | {"event_id": f"e{k}", "timestamp": f"2031-02-03T04:05:{k:02d}.000Z", "event_type": t} for k, t in enumerate(["video_start", "heartbeat", "buffer_start", "buffer_end", "video_end"])]
    path.write_text("\n".join(json.dumps(e) for e in [*events, events[0]]))
    meta = {"_ingested_at": F.current_timestamp(), "_kafka_partition": F.lit(0), "_kafka_offset": F.monotonically_increasing_id()}
    player = spark.read.schema(contracts.PLAYER_V2).json(str(path)).withColumns(meta)
    marker = spark.createDataFrame([("m", "ch", "splice_insert", 1, True, 1, "2031-02-03T04:05:01Z", 30, "commercial")], contracts.MARKER).withColumns(meta)
    content = spark.createDataFrame([tuple(["c1", "title"] + [None] * (len(contracts.CONTENT) - 2))], contracts.CONTENT).withColumns(meta)
    bronze, gold = str(tmp_path / "bronze"), str(tmp_path / "gold")
    assert batch.land({"player_events": player, "scte35_markers": marker, "content_metadata": content}, bronze) == {"player_events": 1, "scte35_markers": 1, "content_metadata": 1}
    assert sinks.read(spark, f"{bronze}/player_events").count() == 6
    one, two = (batch.rebuild(spark, bronze, str(tmp_path / "no-ads"), gold) for _ in range(2))
    assert one["qoe_checksum"] == two["qoe_checksum"] and one["rows"] == {"session_window_qoe": 1, "ccv": 1, "ad_impact": 1, "ad_creatives": 0}
    assert sinks.runs(spark, gold).count() == 2 and sinks.read(spark, f"{gold}/session_window_qoe").first().events == 5
    assert checks.mart_age_hours(sinks.runs(spark, gold), F.current_timestamp()).first().age_hours < 1


def test_a_violated_check_stops_the_export(spark, tmp_path, monkeypatch, sf_dir):
    broken = {"session_window_qoe": marts.session_window_qoe(staged(spark, sf_dir), fixtures.content(spark, sf_dir).dropDuplicates(["content_id"]))}
    nulls = broken["session_window_qoe"].withColumn("session_id", F.lit(None).cast("string"))
    found = checks.violations({"session_window_qoe": nulls.unionByName(nulls.limit(1)), "ccv": spark.createDataFrame([(None,)], "ccv long"), "ad_impact": spark.createDataFrame([(1, "odd")], "event_id_scte int, break_type string"), "ad_creatives": spark.createDataFrame([], "event_id_scte int, advertiser_name string, creative_id string")})
    bad = {r.check_name for r in found.collect() if r.violations}
    assert bad == {"not_null_session_id", "unique_window_key", "not_null_ccv", "accepted_break_type"}
