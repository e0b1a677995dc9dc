"""Burn-rate alerts of delivery networks, over several windows, with hysteresis."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaywatch.functions.time import minute_index


@dataclass(frozen=True)
class BurnRate:
    """budget: share that may be bad; long and short windows in minutes; the least samples; evaluations in a row to fire and to clear."""

    budget: float = 0.01
    fast_long: int = 5
    fast_short: int = 1
    fast_threshold: float = 4.0
    slow_long: int = 30
    slow_short: int = 5
    slow_threshold: float = 2.0
    n_min: int = 50
    fire: int = 2
    clear: int = 3

    @property
    def spans(self) -> tuple[int, ...]:
        return tuple(sorted({self.fast_long, self.fast_short, self.slow_long, self.slow_short}))


def population(windows: DataFrame) -> DataFrame:
    """cdn, minute, session_id, total, bad, samples of each session window; an empty network counts as `unknown`."""
    cdn = F.coalesce(F.nullif(F.col("cdn"), F.lit("")), F.lit("unknown"))
    return windows.select(cdn.alias("cdn"), minute_index(F.col("window_start")).alias("minute"), "session_id", (F.col("rebuffer_ms") + F.col("watch_ms")).alias("total"), F.col("rebuffer_ms").alias("bad"), F.col("events").alias("samples"))


def errors(windows: DataFrame) -> DataFrame:
    """The population for the share of errors among events."""
    return population(windows.withColumns({"rebuffer_ms": F.col("error_count"), "watch_ms": F.col("events") - F.col("error_count")}))


def by_minute(rows: DataFrame) -> DataFrame:
    return rows.groupBy("cdn", "minute").agg(*(F.sum(c).alias(c) for c in ("total", "bad", "samples")))


_SUMS = ("total", "bad", "samples")


def _trailing(rows: DataFrame, how: BurnRate, cadence: str) -> DataFrame:
    """With the sums of each trailing window. By row, a task has a network's minute: what the minutes before it hold is summed by minute and joined."""
    minutes = Window.partitionBy("cdn").orderBy("minute")
    if cadence == "minute":
        return by_minute(rows).withColumns({f"{c}_{n}": F.sum(c).over(minutes.rangeBetween(-(n - 1), 0)) for n in how.spans for c in _SUMS})
    before = by_minute(rows).withColumns({f"{c}_{n}": F.sum(c).over(minutes.rangeBetween(-(n - 1), -1)) if n > 1 else F.lit(0).cast("long") for n in how.spans for c in _SUMS}).drop(*_SUMS)
    so_far = Window.partitionBy("cdn", "minute").orderBy("session_id").rowsBetween(Window.unboundedPreceding, 0)
    here = rows.withColumns({f"_{c}": F.sum(c).over(so_far) for c in _SUMS}).join(before, ["cdn", "minute"])
    return here.withColumns({f"{c}_{n}": F.col(f"_{c}") + F.coalesce(F.col(f"{c}_{n}"), F.lit(0)) for n in how.spans for c in _SUMS}).drop(*(f"_{c}" for c in _SUMS))


def _burn(n: int, how: BurnRate) -> Column:
    return F.when(F.col(f"total_{n}") > 0, F.col(f"bad_{n}").cast("double") / F.col(f"total_{n}") / F.lit(how.budget)).otherwise(0.0)


def burn_rates(rows: DataFrame, how: BurnRate = BurnRate(), cadence: str = "minute") -> DataFrame:
    """An evaluation for each network and minute, or with cadence "row" for each row in order of (minute, session_id).

    Trailing windows include the current minute. `tier` is page, ticket or null.
    """
    out = _trailing(rows, how, cadence)
    out = out.withColumns({f"burn_{n}": _burn(n, how) for n in how.spans})
    fast = (F.col(f"samples_{how.fast_long}") >= how.n_min) & (F.col(f"burn_{how.fast_long}") >= how.fast_threshold) & (F.col(f"burn_{how.fast_short}") >= how.fast_threshold)
    slow = (F.col(f"samples_{how.slow_long}") >= how.n_min) & (F.col(f"burn_{how.slow_long}") >= how.slow_threshold) & (F.col(f"burn_{how.slow_short}") >= how.slow_threshold)
    return out.withColumn("tier", F.when(fast, "page").when(slow, "ticket"))


def _carried(rows: DataFrame, order: tuple[str, ...], *columns: str) -> DataFrame:
    """Each column's last value that isn't null, so far in its minute and, as `<column>_before`, in the minutes before. A task has a network's minute."""
    place = F.struct(*order)
    last = rows.groupBy("cdn", "minute").agg(*(F.max_by(F.col(c), F.when(F.col(c).isNotNull(), place)).alias(f"{c}_before") for c in columns))
    earlier = Window.partitionBy("cdn").orderBy("minute").rowsBetween(Window.unboundedPreceding, -1)
    last = last.withColumns({f"{c}_before": F.last(f"{c}_before", ignorenulls=True).over(earlier) for c in columns})
    so_far = Window.partitionBy("cdn", "minute").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumns({c: F.last(c, ignorenulls=True).over(so_far) for c in columns}).join(last, ["cdn", "minute"])


def _latch_by_row(evaluations: DataFrame, how: BurnRate, order: tuple[str, ...]) -> DataFrame:
    """`latch` for evaluations in order of (minute, *order), whose rows never meet but within a minute."""
    within = Window.partitionBy("cdn", "minute").orderBy(*order)
    counts = evaluations.groupBy("cdn", "minute").agg(F.count("*").alias("_rows"))
    counts = counts.select("cdn", "minute", F.coalesce(F.sum("_rows").over(Window.partitionBy("cdn").orderBy("minute").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_earlier"))
    active = F.col("tier").isNotNull()
    e = evaluations.withColumn("_row", F.row_number().over(within)).join(counts, ["cdn", "minute"]).withColumn("_n", F.col("_row") + F.col("_earlier"))
    e = e.select("cdn", "minute", *order, "_n", F.col("tier").alias("_tier"), F.when(active, F.col("_n")).alias("_active"), F.when(~active, F.col("_n")).alias("_idle"))
    known = lambda c: F.coalesce(F.col(c), F.col(f"{c}_before"))
    e = _carried(e, order, "_tier", "_active", "_idle")
    on, off = F.col("_n") - F.coalesce(known("_idle"), F.lit(0)), F.col("_n") - F.coalesce(known("_active"), F.lit(0))
    e = e.select("cdn", "minute", *order, known("_tier").alias("tier"), F.when(on >= how.fire, 1).when(off >= how.clear, 0).alias("_set"))
    e = _carried(e, order, "_set")
    now = F.coalesce(known("_set"), F.lit(0))
    e = e.withColumn("_is", now).withColumn("_was", F.coalesce(F.lag("_is").over(within), "_set_before", F.lit(0)))
    return e.where("_is <> _was").select("cdn", F.when(F.col("_is") == 1, "FIRING").otherwise("RESOLVED").alias("state"), "tier", "minute")


def latch(evaluations: DataFrame, how: BurnRate = BurnRate(), order: tuple[str, ...] = ("minute",)) -> DataFrame:
    """cdn, state, tier, minute of each transition.

    A run of `fire` active evaluations sets the latch, a run of `clear` inactive
    ones resets it, and nothing else moves it; so its state is the last such
    run's. A reset carries the tier of the last active evaluation.
    """
    if len(order) > 1:
        return _latch_by_row(evaluations, how, order[1:])
    w = Window.partitionBy("cdn").orderBy(*order)
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    active = F.col("tier").isNotNull()
    e = evaluations.withColumn("_n", F.row_number().over(w))
    e = e.withColumns({
        "_on": F.col("_n") - F.coalesce(F.max(F.when(~active, F.col("_n"))).over(so_far), F.lit(0)),
        "_off": F.col("_n") - F.coalesce(F.max(F.when(active, F.col("_n"))).over(so_far), F.lit(0)),
        "_tier": F.last("tier", ignorenulls=True).over(so_far),
    })
    e = e.withColumn("_set", F.when(F.col("_on") >= how.fire, 1).when(F.col("_off") >= how.clear, 0))
    e = e.withColumn("_is", F.coalesce(F.last("_set", ignorenulls=True).over(so_far), F.lit(0)))
    e = e.withColumn("_was", F.coalesce(F.lag("_is").over(w), F.lit(0)))
    return e.where("_is <> _was").select("cdn", F.when(F.col("_is") == 1, "FIRING").otherwise("RESOLVED").alias("state"), F.col("_tier").alias("tier"), "minute")


def error_transitions(windows: DataFrame, how: BurnRate = BurnRate()) -> DataFrame:
    """Transitions of the alert on the share of errors among events."""
    return latch(burn_rates(errors(windows), how), how)


def transitions(windows: DataFrame, how: BurnRate = BurnRate(), cadence: str = "minute") -> DataFrame:
    order = ("minute",) if cadence == "minute" else ("minute", "session_id")
    return latch(burn_rates(population(windows), how, cadence), how, order)
