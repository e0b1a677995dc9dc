"""Landing: raw records as they came, flattened, with ingestion metadata.

Nothing is deduplicated, reordered or defaulted here. Where the broker's and
the Avro and table formats' jars are on the class path, `source` takes their
names; without them, folders of JSON lines and Parquet stand in.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaywatch.sources import contracts

HOUR = "yyyy-MM-dd'T'HH"
META = ("_ingested_at", "_kafka_partition", "_kafka_offset")
ARRIVAL = ("file_time", "file_path", "file_block", "file_line")


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, strict: bool = True) -> DataFrame:
    """JSON lines under a declared schema; blank lines are skipped.

    strict: a malformed line ends the read. Otherwise it's dropped: `_corrupt`
    lines are counted by `observe`, not kept.
    """
    if strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    loose = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    return spark.read.schema(loose).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path).where("_corrupt is null").drop("_corrupt")


@F.pandas_udf(T.LongType())
def _counted(rows: Iterator[pd.Series]) -> Iterator[pd.Series]:
    n = 0
    for part in rows:
        yield pd.Series(range(n, n + len(part)), dtype="int64")
        n += len(part)


def stream_jsonl(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None, arrival: bool = False) -> DataFrame:
    """A folder of JSON lines as a stream; malformed lines are dropped.

    arrival: with ARRIVAL, which orders lines as they lie in their files, older
    files first. Tasks read a large file in blocks, so rows that went through a
    shuffle have that order no more. `file_line` counts within a task.
    """
    loose = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    reader = spark.readStream.schema(loose).option("columnNameOfCorruptRecord", "_corrupt")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    rows = reader.json(path)
    if arrival:
        rows = rows.select("*", F.unix_micros("_metadata.file_modification_time").alias("file_time"), F.col("_metadata.file_path"), F.col("_metadata.file_block_start").alias("file_block"))
        rows = rows.withColumn("file_line", _counted.asNondeterministic()("file_block"))
    return rows.where("_corrupt is null").drop("_corrupt")


def decode(raw: DataFrame, schema: T.StructType, strict: bool) -> DataFrame:
    """Messages' `value` as records beside META; strict: a malformed message ends the read, else it's dropped."""
    options = {"mode": "FAILFAST"} if strict else {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    kind = schema if strict else T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    out = raw.withColumn("_r", F.from_json(F.col("value").cast("string"), kind, options))
    if not strict:
        out = out.where("_r is not null and _r._corrupt is null")
    return out.select(*(F.col("_r")[f.name].alias(f.name) for f in schema), *META)


def broker(spark: SparkSession, servers: str, topic: str, stream: bool = False) -> DataFrame:
    """A topic's messages with META, from the earliest to the latest, or as a stream; needs the broker's jar."""
    reader = (spark.readStream if stream else spark.read).format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", "earliest")
    return reader.load().select("value", F.col("timestamp").alias("_ingested_at"), F.col("partition").alias("_kafka_partition"), F.col("offset").alias("_kafka_offset"))


def stream_messages(spark: SparkSession, path: str) -> DataFrame:
    """A folder of messages, a line each, as a stream: the stand-in of a topic of one partition. The file's time is the message's."""
    lines = spark.readStream.text(path).where("trim(value) <> ''")
    return lines.select("value", F.col("_metadata.file_modification_time").alias("_ingested_at"), F.lit(0).alias("_kafka_partition"))


def drain(messages: DataFrame, path: str, checkpoint: str) -> None:
    """What is there of a stream when this begins, as a table with META; it ends by itself. A later call goes on where this one stopped.

    Where messages have no offset, batches number them: growing, with gaps.
    """

    def batch(df: DataFrame, n: int) -> None:
        if "_kafka_offset" not in df.columns:
            df = df.withColumn("_kafka_offset", F.lit(n << 46) + F.monotonically_increasing_id())
        df.write.mode("append").parquet(path)

    messages.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _time(iso: str) -> Column:
    return F.to_timestamp(F.col(iso))


def flatten_player(raw: DataFrame) -> DataFrame:
    """Player records of either version; a version 1 record has null version 2 fields."""
    has = set(raw.columns)
    later = [F.col(n) if n in has else F.lit(None).cast("string").alias(n) for n in ("schema_version", "network_type")]
    event_time = _time("timestamp")
    return raw.select(
        "event_id", "session_id", "user_id", event_time.alias("event_time"), "event_type", "content_id", "is_live",
        F.col("device.type").alias("device_type"), F.col("device.model").alias("device_model"), F.col("device.os").alias("device_os"), F.col("device.app_version").alias("app_version"),
        *(F.col(f"geo.{n}").alias(f"geo_{n}") for n in ("region", "state", "city", "isp")),
        "cdn", "bitrate_kbps", "buffer_length_ms", "playhead_position_s", "error_code", *later, F.date_format(event_time, HOUR).alias("event_hour"), *META,
    )


def flatten_markers(raw: DataFrame) -> DataFrame:
    return raw.select(*(_time("wallclock").alias("wallclock") if f.name == "wallclock" else F.col(f.name) for f in contracts.MARKER), *META)


def flatten_content(raw: DataFrame) -> DataFrame:
    return raw.select(*(f.name for f in contracts.CONTENT), *META)


def read_ads(spark: SparkSession, path: str) -> DataFrame:
    """Ad decisions; an absent feed is an empty table with all columns."""
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(there):
        return spark.createDataFrame([], contracts.AD_DECISION)
    return read_jsonl(spark, path, contracts.AD_DECISION)


def timeline(players: DataFrame, markers: DataFrame) -> DataFrame:
    """Both feeds in one order of time: (at, topic, key, value), value as JSON."""
    one = players.select(_time("timestamp").alias("at"), F.lit("player_events").alias("topic"), F.col("session_id").alias("key"), F.to_json(F.struct(*players.columns)).alias("value"))
    two = markers.select(_time("wallclock").alias("at"), F.lit("scte35_markers").alias("topic"), F.col("channel").alias("key"), F.to_json(F.struct(*markers.columns)).alias("value"))
    return one.unionByName(two).orderBy("at", "topic", "key", "value")


def publish(players: DataFrame, path: str, n: int = 6) -> None:
    """Player records as JSON lines, in n files by session; a record is version 2 where it has network_type, else version 1, without its fields.

    Values out of their version's domains end the write.
    """
    old, new = contracts.CONTRACTS["player_events"]
    if "network_type" not in players.columns:
        checked = contracts.require_domain(players, old)
    else:
        newer = F.col("network_type").isNotNull()
        fault = F.when(newer, contracts.out_of_domain(new)).otherwise(contracts.out_of_domain(old))
        checked = contracts.refuse(players, fault)
        if "schema_version" in players.columns:
            checked = checked.withColumn("schema_version", F.when(newer, F.col("schema_version")))
    checked.repartition(n, "session_id").write.option("ignoreNullFields", "true").json(path)
