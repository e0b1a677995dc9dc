"""Tables in folders: overwrite, append, upsert, compaction, versions and the run manifest.

A table is a folder of Parquet partitions. Beside it, so that nothing that
replaces the folder takes them along, lie `<path>.versions`, with a file for each
commit, and `<path>.old`, with what commits have replaced, until `vacuum`.

Rows are replaced by moves: new folders are written whole beside the table, then
a plan of the moves is put down, and only then do folders change places. What a
crash leaves is brought to its end by the next `read` or write. A reader that
listed files before a move should read again. Everything goes through Hadoop's
file systems, so a table can be in any store that Spark reaches.
"""

from __future__ import annotations

import json
import logging
import time
import uuid
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

_INFERS = "spark.sql.sources.partitionColumnTypeInference.enabled"


def _fs(spark: SparkSession, path: str):
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), there


def exists(spark: SparkSession, path: str) -> bool:
    fs, there = _fs(spark, path)
    return fs.exists(there)


def has_table(spark: SparkSession, path: str) -> bool:
    return version(spark, path) > 0


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, there = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(there)) if fs.exists(there) else []


def remove(spark: SparkSession, path: str) -> bool:
    fs, there = _fs(spark, path)
    return bool(fs.delete(there, True))


def move(spark: SparkSession, from_: str, to: str, at: int | None = None) -> None:
    """at: the file counts as written that many milliseconds from now, for readers that go by time."""
    fs, there = _fs(spark, from_)
    _, target = _fs(spark, to)
    fs.mkdirs(target.getParent())
    if not fs.rename(there, target):
        raise OSError(f"{from_} can't become {to}")
    if at is not None:
        fs.setTimes(target, int(time.time() * 1000) + at, -1)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A new file; an error where there is one."""
    fs, there = _fs(spark, path)
    out = fs.create(there, False)
    out.write(bytearray(text.encode()))
    out.close()


def _text(spark: SparkSession, path: str) -> str:
    fs, there = _fs(spark, path)
    source = fs.open(there)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def version(spark: SparkSession, path: str) -> int:
    """The last commit's number; 0 where there is no table."""
    return max((int(n.removesuffix(".json")) for n in _names(spark, f"{path}.versions") if n.endswith(".json")), default=0)


def _commit(spark: SparkSession, path: str, what: str) -> int:
    """The commit's number; of two writers that take the same, the later takes the next."""
    n = version(spark, path) + 1
    while True:
        try:
            put_text(spark, f"{path}.versions/{n:08d}.json", json.dumps({"version": n, "operation": what}))
            return n
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in str(e.java_exception):
                raise
            n += 1


def _replace(spark: SparkSession, path: str, staged: str, folders: list[str], what: str) -> int:
    """The staged folders take the places of the table's, "" being the whole; the plan of it outlives a crash."""
    put_text(spark, f"{path}.versions/plan", json.dumps({"staged": staged, "old": f"{path}.old/{uuid.uuid4().hex}", "folders": folders, "operation": what}))
    return recover(spark, path)


def recover(spark: SparkSession, path: str) -> int:
    """Carries out what is left of a plan, if there is one; the table's version."""
    plan = f"{path}.versions/plan"
    if not exists(spark, plan):
        return version(spark, path)
    todo = json.loads(_text(spark, plan))
    for folder in todo["folders"]:
        at = lambda top: f"{top}/{folder}" if folder else top
        if exists(spark, at(todo["staged"])):  # else it has its place already
            if exists(spark, at(path)):
                move(spark, at(path), at(todo["old"]))
            move(spark, at(todo["staged"]), at(path))
    n = _commit(spark, path, todo["operation"])
    remove(spark, plan)
    remove(spark, todo["staged"])
    return n


def _load(reader, spark: SparkSession, *paths: str) -> DataFrame:
    """Partition values stay text; the session's setting is put back once they have been found."""
    before = spark.conf.get(_INFERS, None)
    spark.conf.set(_INFERS, "false")
    try:
        return reader.parquet(*paths)
    finally:
        spark.conf.set(_INFERS, before) if before is not None else spark.conf.unset(_INFERS)


def read(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The table; partition values stay text. An absent table is empty if a schema says of what."""
    recover(spark, path)
    if schema is not None and not has_table(spark, path) and not exists(spark, path):
        return spark.createDataFrame([], schema)
    return _load(spark.read if schema is None else spark.read.schema(schema), spark, path)


def typed(df: DataFrame, hints: dict[str, str] | None = None) -> DataFrame:
    """Columns without a type, which hold only nulls, take the hinted type or string; so a first batch can't fix a wrong one."""
    hints = hints or {}
    return df.select(*(F.col(f"`{f.name}`").cast(hints.get(f.name, "string")).alias(f.name) if isinstance(f.dataType, T.NullType) else F.col(f"`{f.name}`") for f in df.schema))


def _stage(df: DataFrame, path: str, partition_by: list[str] | None) -> str:
    staged = f"{path}-staged-{uuid.uuid4().hex}"
    parts = df.write
    (parts.partitionBy(*partition_by) if partition_by else parts).parquet(staged)
    return staged


def overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None, keep_if_empty: bool = True) -> int:
    """The table becomes `df`, stale partitions included; an empty input is reported and changes nothing. The new version, or 0."""
    spark = df.sparkSession
    if keep_if_empty and df.isEmpty():
        log.warning("nothing to write to %s", path)
        return 0
    recover(spark, path)
    return _replace(spark, path, _stage(typed(df), path, partition_by), [""], "overwrite")


def append(df: DataFrame, path: str, partition_by: list[str] | None = None, hints: dict[str, str] | None = None) -> int:
    """Rows are added as files; readers take the newest of a key (`staging.dedupe_on_read`)."""
    recover(df.sparkSession, path)
    parts = typed(df, hints).write.mode("append")
    (parts.partitionBy(*partition_by) if partition_by else parts).parquet(path)
    return _commit(df.sparkSession, path, "append")


def upsert(batch: DataFrame, path: str, keys: list[str], partition_by: list[str], hints: dict[str, str] | None = None) -> int:
    """Rows of known keys are replaced, others added; only partitions that the batch touches are read and rewritten.

    Partition columns are part of a key. Of a key's rows in one batch, one stays.
    An empty batch changes nothing.
    """
    spark, batch = batch.sparkSession, typed(batch, hints)
    recover(spark, path)
    batch = batch.dropDuplicates(keys).persist()
    try:
        return _upsert(spark, batch, path, keys, partition_by)
    finally:
        batch.unpersist()


def _upsert(spark: SparkSession, batch: DataFrame, path: str, keys: list[str], partition_by: list[str]) -> int:
    if batch.isEmpty():
        return version(spark, path)
    if not has_table(spark, path) and not exists(spark, path):
        return _replace(spark, path, _stage(batch, path, partition_by), [""], "upsert")
    held = read(spark, path)
    touched = batch.select(*partition_by).distinct()
    kept = held.join(touched, partition_by, "left_semi").join(batch.select(*keys), keys, "left_anti")
    staged = _stage(kept.select(*batch.columns).unionByName(batch), path, partition_by)
    return _replace(spark, path, staged, sorted({f for f, _, _ in listed(spark, staged)}), "upsert")


def listed(spark: SparkSession, path: str) -> list[tuple[str, str, int]]:
    """Folder below the path, name and bytes of each data file."""
    fs, there = _fs(spark, path)
    top, out = fs.makeQualified(there).toUri().getPath(), []
    it = fs.listFiles(there, True)
    while it.hasNext():
        f = it.next()
        name = f.getPath().getName()
        if name.startswith("part-") and not name.endswith(".crc"):
            out.append((f.getPath().getParent().toUri().getPath().removeprefix(top).strip("/"), name, f.getLen()))
    return out


def files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Data files below the path, and their bytes."""
    return [(f"{path}/{folder}/{name}" if folder else f"{path}/{name}", size) for folder, name, size in listed(spark, path)]


def compact(spark: SparkSession, path: str, partition_by: list[str], target_bytes: int = 128 << 20) -> tuple[int, int]:
    """Partitions with more files than their bytes need are rewritten as files of about target_bytes; files before and after.

    Rows stay the same; other partitions aren't read. An absent table has no files.
    """
    recover(spark, path)
    if not exists(spark, path):
        return 0, 0
    found: dict[str, list[int]] = {}
    for folder, _, size in listed(spark, path):
        found.setdefault(folder, []).append(size)
    before = sum(map(len, found.values()))
    want = {f: max(1, round(sum(sizes) / target_bytes)) for f, sizes in found.items()}
    small = sorted(f for f, sizes in found.items() if len(sizes) > want[f])
    if not small:
        return before, before
    rows = _load(spark.read.option("basePath", path), spark, *(f"{path}/{f}" if f else path for f in small))
    # Each of a partition's shares goes to one task and is a file of its own, in a folder `_share=k` that its file then leaves.
    escaped = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    values = {f: [escaped.unescapePathName(p.partition("=")[2]) for p in f.split("/") if p] for f in small}
    nothing = escaped.DEFAULT_PARTITION_NAME()
    shares = spark.createDataFrame([(*(None if v == nothing else v for v in values[f]), want[f]) for f in small], ", ".join([*(f"`_k{k}` string" for k in range(len(partition_by))), "_shares int"]))
    match = F.lit(True)
    for k, name in enumerate(partition_by):
        match = match & F.col(f"`{name}`").cast("string").eqNullSafe(F.col(f"_k{k}"))
    dealt = rows.join(shares, match, "left") if partition_by else rows.withColumn("_shares", F.lit(want[""]))
    dealt = dealt.withColumn("_share", F.floor(F.rand(7) * F.coalesce("_shares", F.lit(1))).cast("int")).select(*rows.columns, "_share")
    staged = _stage(dealt.repartition(*partition_by, "_share"), path, [*partition_by, "_share"])
    for folder, name, _ in listed(spark, staged):
        home, _, share = folder.rpartition("_share=")
        move(spark, f"{staged}/{folder}/{name}", f"{staged}/{home}part-{share}-{name.removeprefix('part-')}")
        remove(spark, f"{staged}/{folder}")
    _replace(spark, path, staged, small, "compact")
    after = len(listed(spark, path))
    log.info("%s: %d files became %d", path, before, after)
    return before, after


def vacuum(spark: SparkSession, path: str, retain_hours: float = 0) -> int:
    """Replaced folders older than retain_hours go, and so do leftover staging folders and temporary files; how many."""
    recover(spark, path)
    fs, there = _fs(spark, path)
    gone, oldest = 0, (time.time() - retain_hours * 3600) * 1000
    _, old = _fs(spark, f"{path}.old")
    for s in fs.listStatus(old) if fs.exists(old) else []:
        if s.getModificationTime() <= oldest:
            gone += bool(fs.delete(s.getPath(), True))
    for s in fs.listStatus(there.getParent()):
        if s.getPath().getName().startswith(f"{there.getName()}-staged-"):
            gone += bool(fs.delete(s.getPath(), True))
    for s in fs.listStatus(there) if fs.exists(there) else []:
        if s.getPath().getName().startswith((".spark-staging", "_temporary")):
            gone += bool(fs.delete(s.getPath(), True))
    return gone


def add_run(spark: SparkSession, folder: str, record: dict) -> dict:
    """A run's record in the manifest, a file of its own: stores needn't append."""
    record = {"run_id": str(uuid.uuid4()), "run_at": datetime.now(timezone.utc).isoformat(), **record}
    put_text(spark, f"{folder}/runs/{record['run_at'].replace(':', '')}-{record['run_id']}.json", json.dumps(record))
    return record


def runs(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("run_id string, run_at string, bronze_player_version long, rows map<string,long>, qoe_checksum string").json(f"{folder}/runs")
