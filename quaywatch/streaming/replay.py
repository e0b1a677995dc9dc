"""Replay of a timeline as files, paced by event time, and taps on streams."""

from __future__ import annotations

import json
import logging
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from quaywatch.operators import sinks

log = logging.getLogger(__name__)


def replay(timeline: DataFrame, path: str, speed: float = 60.0, slice_s: int = 10, files: int = 1, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> int:
    """Messages of each topic as JSON lines in `path`/topic, by slices of event time; how many slices.

    Executors write all slices beside `path`, each as `files` files by key, sorted; a
    slice's files are moved in when it is due: at start + its distance /
    speed, whatever earlier ones took, so delays don't add up. Only names come to the driver.
    """
    spark = timeline.sparkSession
    staged = f"{path}-staged-{uuid.uuid4().hex}"
    sliced = timeline.withColumns({"_slice": F.floor(F.unix_timestamp("at") / slice_s), "_file": F.pmod(F.xxhash64("key"), F.lit(files))})
    sliced = sliced.repartition("_slice", "topic", "_file").sortWithinPartitions("_slice", "topic", "_file", "at", "key", "value")
    sliced.select("value", "_slice", "topic").write.partitionBy("_slice", "topic").text(staged)
    due: dict[int, list[tuple[str, str]]] = {}
    for folder, name, _ in sinks.listed(spark, staged):
        number, topic = (p.partition("=")[2] for p in folder.split("/"))
        due.setdefault(int(number), []).append((f"{staged}/{folder}/{name}", f"{path}/{topic}/slice-{int(number):012d}-{name.removeprefix('part-')}"))
    began, numbers = clock(), sorted(due)
    for k, n in enumerate(numbers):
        wait = began + (n - numbers[0]) * slice_s / speed - clock()
        if wait > 0:
            sleep(wait)
        for from_, to in sorted(due[n]):
            sinks.move(spark, from_, to, at=k)
    sinks.remove(spark, staged)
    return len(numbers)


def tap(df: DataFrame, name: str) -> DataFrame:
    """The rows, whose number each batch reports under `name`."""
    return df.observe(name, F.count(F.lit(1)).alias("n"))


class Progress(StreamingQueryListener):
    """Progress of all queries: observed counts and rows that came too late are logged, and kept in `seen`."""

    def __init__(self) -> None:
        self.seen: list[dict] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        self.seen.append(p)
        late = sum(s.get("numRowsDroppedByWatermark", 0) for s in p.get("stateOperators", []))
        if late:
            log.warning("%s: %d events came too late", p.get("name"), late)
        for name, row in p.get("observedMetrics", {}).items():
            log.info("%s: %s", name, row)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
