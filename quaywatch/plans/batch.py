"""The batch layer's runs: landing, and rebuilding the marts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quaywatch.operators import sinks, staging
from quaywatch.plans import checks, marts
from quaywatch.sources import contracts, landing


class ChecksFailed(RuntimeError):
    pass


def land(raw: dict[str, DataFrame], bronze: str) -> dict[str, int]:
    """Raw records of each topic into its table, as they came; the version of each, 0 where there was nothing."""
    plan = {"player_events": (landing.flatten_player, ["event_hour"]), "scte35_markers": (landing.flatten_markers, None), "content_metadata": (landing.flatten_content, None)}
    return {topic: sinks.overwrite(plan[topic][0](df), f"{bronze}/{topic}", plan[topic][1]) for topic, df in raw.items()}


def build(player: DataFrame, markers: DataFrame, content: DataFrame, ads: DataFrame, keep: Callable[[DataFrame], DataFrame] = DataFrame.persist) -> dict[str, DataFrame]:
    """The four marts; the first is kept, by caching or as `keep` does, since three readers follow."""
    qoe = keep(marts.session_window_qoe(staging.player_events(player), staging.latest_content(content)))
    return {"session_window_qoe": qoe, "ccv": marts.ccv(qoe), "ad_impact": marts.ad_impact(markers, qoe, ads), "ad_creatives": marts.ad_creatives(markers, ads)}


def rebuild(spark: SparkSession, bronze: str, ads_path: str, gold: str, gate: bool = True) -> dict:
    """All marts from the landed tables, checked, exported and recorded.

    gate: a violated check ends the run before anything is exported; without
    it, violations are only recorded.
    """
    tables = {t: sinks.read(spark, f"{bronze}/{t}") for t in ("player_events", "scte35_markers", "content_metadata")}
    ads = landing.read_ads(spark, ads_path)
    built = build(*tables.values(), ads)
    found = {f"{r.mart}.{r.check_name}": r.violations for r in checks.violations(built).collect() if r.violations}
    if found and gate:
        built["session_window_qoe"].unpersist()
        raise ChecksFailed(str(found))
    for name, df in built.items():
        sinks.overwrite(df if name == "session_window_qoe" else df.coalesce(1), f"{gold}/{name}", ["window_hour"] if name == "session_window_qoe" else None, keep_if_empty=False)
    record = {
        "bronze_player_version": sinks.version(spark, f"{bronze}/player_events"),
        "rows": {name: df.count() for name, df in built.items()},
        "qoe_checksum": marts.checksum(built["session_window_qoe"]).first().qoe_checksum,
        "violations": found,
    }
    built["session_window_qoe"].unpersist()
    return sinks.add_run(spark, gold, record)


def bind(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Tables under the names that SQL calls them by."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def bootstrap_contracts() -> dict[str, int]:
    return contracts.Registry().bootstrap()
