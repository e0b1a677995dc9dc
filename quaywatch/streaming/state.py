"""Stateful stream processors: exact bounded dedupe, and alerts.

Both need the RocksDB state store: `use_rocksdb`.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from quaywatch.plans.alerts import BurnRate, population


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """The RocksDB store for streams that start here; the session's own setting is put back."""
    before = spark.conf.get(_PROVIDER, None)
    use_rocksdb(spark)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before) if before is not None else spark.conf.unset(_PROVIDER)


class Horizon:
    """Ids seen within `horizon_s` of the latest event, of one session; a heap has the oldest first, so an event costs the logarithm of what is held."""

    def __init__(self, horizon_s: float, seen: dict[str, float] | None = None):
        self.horizon_s, self.seen = horizon_s, dict(seen or {})
        self.by_time = [(t, k) for k, t in self.seen.items()]
        heapq.heapify(self.by_time)
        self.latest = max(self.seen.values(), default=float("-inf"))

    def is_copy(self, event_id: str, at: float) -> bool:
        """Whether the id is held; an id seen first is taken in, and ids that have fallen behind leave, itself perhaps."""
        if event_id in self.seen:
            return True
        self.seen[event_id] = at
        heapq.heappush(self.by_time, (at, event_id))
        self.latest = max(self.latest, at)
        while self.by_time[0][0] < self.latest - self.horizon_s:
            del self.seen[heapq.heappop(self.by_time)[1]]
        return False


def _ordered(rows: Iterator[pd.DataFrame], by: Sequence[str]) -> Iterator[pd.DataFrame]:
    """The rows in order of the columns, which takes all of them at once; without columns as they come."""
    if not by:
        yield from rows
        return
    pdf = pd.concat(list(rows), ignore_index=True)
    at = list(zip(*(pdf[c] for c in by)))
    yield pdf.iloc[sorted(range(len(at)), key=at.__getitem__)]


def bounded_dedupe(events: DataFrame, horizon_s: float = 180, arrival: Sequence[str] = ()) -> DataFrame:
    """First copies only, by session, with the horizon of `Horizon`.

    arrival: columns without nulls that order a session's rows within a batch,
    such as `landing.ARRIVAL` or a broker's partition and offset; they aren't
    returned. Without them rows count as they come from the shuffle, which has
    the order of arrival only where one task reads all that the batch has of
    a session. A batch's rows of one session are held in memory to sort them.
    """
    schema = StructType([f for f in events.schema if f.name not in arrival])
    order = {c: f"arrival_{k}" for k, c in enumerate(arrival)}  # a name with a leading underscore doesn't get to Python
    events = events.select(*schema.names, *(F.col(c).alias(o) for c, o in order.items()))

    class Dedupe(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.state = handle.getValueState("seen", "seen string")

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            held = Horizon(horizon_s, json.loads(self.state.get()[0]) if self.state.exists() else None)
            for pdf in _ordered(rows, list(order.values())):
                fresh = [not held.is_copy(i, t.timestamp()) for i, t in zip(pdf["event_id"], pdf["event_time"])]
                yield pdf[fresh][schema.names]
            self.state.update((json.dumps(held.seen),))

        def close(self) -> None:
            pass

    return events.groupBy("session_id").transformWithStateInPandas(Dedupe(), schema, "append", "None")


class Burn:
    """A network's minutes within the longest window, and the latch; one `advance` an evaluation."""

    def __init__(self, how: BurnRate, minutes: dict[int, list] | None = None, on: int = 0, off: int = 0, firing: bool = False, tier: str | None = None):
        self.how, self.minutes = how, {int(m): list(v) for m, v in (minutes or {}).items()}
        self.on, self.off, self.firing, self.tier = on, off, firing, tier

    def dump(self) -> str:
        return json.dumps({"minutes": self.minutes, "on": self.on, "off": self.off, "firing": self.firing, "tier": self.tier})

    def _sum(self, span: int) -> tuple[float, float, int]:
        from_ = max(self.minutes) - span
        some = [v for m, v in self.minutes.items() if m > from_]
        return tuple(sum(v[k] for v in some) for k in range(3))

    def _over(self, long: int, short: int, threshold: float) -> bool:
        burns = [bad / total / self.how.budget if total > 0 else 0.0 for total, bad, _ in (self._sum(long), self._sum(short))]
        return self._sum(long)[2] >= self.how.n_min and min(burns) >= threshold

    def advance(self, minute: int, total: float, bad: float, samples: int) -> tuple[str, str, int] | None:
        """(state, tier, minute) if the latch moves."""
        how, had = self.how, self.minutes.get(minute, [0, 0, 0])
        self.minutes[minute] = [had[0] + total, had[1] + bad, had[2] + samples]
        newest = max(self.minutes)
        self.minutes = {m: v for m, v in self.minutes.items() if m > newest - max(how.spans)}
        tier = "page" if self._over(how.fast_long, how.fast_short, how.fast_threshold) else "ticket" if self._over(how.slow_long, how.slow_short, how.slow_threshold) else None
        self.on, self.off = (self.on + 1, 0) if tier else (0, self.off + 1)
        self.tier = tier or self.tier
        if self.firing != (self.on >= how.fire if not self.firing else self.off < how.clear):
            self.firing = not self.firing
            return ("FIRING" if self.firing else "RESOLVED", self.tier, minute)
        return None


def alert_stream(rows: DataFrame, how: BurnRate = BurnRate()) -> DataFrame:
    """cdn, state, tier, minute of each transition. rows: finished windows, in append mode.

    All windows of a minute finish in one batch, so a batch's minutes are
    evaluated whole, in order.
    """

    class Alerts(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.state = handle.getValueState("burn", "burn string")

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            burn = Burn(how, **json.loads(self.state.get()[0])) if self.state.exists() else Burn(how)
            sums = pd.concat([pdf[["minute", "total", "bad", "samples"]] for pdf in rows]).groupby("minute").sum()
            out = [(key[0], *moved) for m, r in sums.sort_index().iterrows() if (moved := burn.advance(int(m), int(r.total), int(r.bad), int(r.samples)))]
            self.state.update((burn.dump(),))
            yield pd.DataFrame(out, columns=["cdn", "state", "tier", "minute"]).astype({"minute": "int64"})

        def close(self) -> None:
            pass

    schema = StructType.fromDDL("cdn string, state string, tier string, minute long")
    return population(rows).groupBy("cdn").transformWithStateInPandas(Alerts(), schema, "append", "None")


def alerts_to_table(rows: DataFrame, path: str, checkpoint: str, how: BurnRate = BurnRate(), trigger: dict | None = None) -> StreamingQuery:
    """Transitions with processed_at, appended to a table that `serving.current_alerts` reads."""
    out = alert_stream(rows, how).withColumn("processed_at", F.current_timestamp())
    return out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start(path)
