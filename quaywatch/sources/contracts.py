"""Versioned record contracts: declared schemas, compatibility, defaults and domains."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The event types, break types and network types of the records.
EVENT_TYPES = ("video_start", "video_end", "heartbeat", "buffer_start", "buffer_end", "bitrate_switch", "ad_start", "ad_end", "error", "seek")
BREAK_TYPES = ("commercial", "program_boundary", "blackout")
SPLICE_COMMANDS = ("splice_insert", "time_signal")
NETWORK_TYPES = ("wifi", "cellular", "ethernet", "unknown")

_S, _I, _L, _B = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType()


def _record(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


DEVICE = _record(*((n, _S) for n in ("type", "model", "os", "app_version")))
GEO = _record(*((n, _S) for n in ("region", "state", "city", "isp")))
PLAYER_V1 = _record(
    *((n, _S) for n in ("event_id", "session_id", "user_id", "timestamp", "event_type", "content_id")), ("is_live", _B), ("device", DEVICE), ("geo", GEO), ("cdn", _S),
    ("bitrate_kbps", _I), ("buffer_length_ms", _I), ("playhead_position_s", _I), ("error_code", _S),
)
PLAYER_V2 = T.StructType([*PLAYER_V1.fields, T.StructField("schema_version", _S), T.StructField("network_type", _S)])
MARKER = _record(
    ("marker_id", _S), ("channel", _S), ("splice_command", _S), ("event_id_scte", _I), ("out_of_network", _B), ("pts_time", _L), ("wallclock", _S), ("duration_s", _I), ("break_type", _S)
)
CONTENT = _record(
    ("content_id", _S), ("title", _S), ("genre", _S), ("is_live", _B), ("is_premium", _B),
    *((n, _S) for n in ("scheduled_start_utc", "scheduled_end_utc", "rights_window_start", "rights_window_end")), ("rights_territories", T.ArrayType(_S)),
    *((n, _S) for n in ("classification", "ad_pod_policy", "language")), ("duration_min", _I), *((n, _S) for n in ("eidr_id", "gracenote_id", "created_at", "updated_at")),
)
AD_DECISION = _record(
    ("decision_id", _S), ("marker_id", _S), ("event_id_scte", _I), ("channel", _S), ("user_id_anon", _S), ("slot_index", _I), ("creative_id", _S), ("creative_duration_s", _I),
    ("advertiser_id", _S), ("advertiser_name", _S), ("price_cpm_brl", T.DecimalType(10, 2)), ("served_ts", T.TimestampType()), ("ssai_provider", _S),
)

NONE = object()


@dataclass(frozen=True)
class Contract:
    """A schema, the defaults of fields that a reader may miss, and domains of fields."""

    schema: T.StructType
    defaults: dict[str, Any] = field(default_factory=dict)
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)


CONTRACTS: dict[str, tuple[Contract, ...]] = {
    "player_events": (
        Contract(PLAYER_V1, {"error_code": None}, {"event_type": EVENT_TYPES}),
        Contract(PLAYER_V2, {"error_code": None, "schema_version": "v1", "network_type": "unknown"}, {"event_type": EVENT_TYPES, "network_type": NETWORK_TYPES}),
    ),
    "scte35_markers": (Contract(MARKER, {}, {"splice_command": SPLICE_COMMANDS, "break_type": BREAK_TYPES}),),
    "content_metadata": (Contract(CONTENT),),
}


def subject(topic: str) -> str:
    return f"{topic}-value"


class Incompatible(ValueError):
    pass


def backward_faults(old: Contract, new: Contract) -> list[str]:
    """Why a reader of `new` can't read what `old` wrote; empty where it can."""
    had = {f.name: f.dataType for f in old.schema}
    out = [f"{f.name}: new without a default" for f in new.schema if f.name not in had and f.name not in new.defaults]
    out += [f"{f.name}: {had[f.name].simpleString()} became {f.dataType.simpleString()}" for f in new.schema if f.name in had and not _widens(had[f.name], f.dataType)]
    out += [f"{n}: no longer allows {', '.join(sorted(set(d) - set(new.domains[n])))}" for n, d in old.domains.items() if n in new.domains and set(d) - set(new.domains[n]) and n not in new.defaults]
    return out


def _widens(old: T.DataType, new: T.DataType) -> bool:
    ranks = {"int": 0, "bigint": 1, "float": 2, "double": 3}
    a, b = old.simpleString(), new.simpleString()
    return a == b or (a in ranks and b in ranks and ranks[a] <= ranks[b])


class Registry:
    """Versions by subject. The first sets the subject up; later ones must read all that the last wrote."""

    def __init__(self) -> None:
        self.versions: dict[str, list[Contract]] = {}

    def register(self, topic: str, contract: Contract) -> int:
        """The version's number, from 1; registering a known one again changes nothing."""
        held = self.versions.setdefault(subject(topic), [])
        if contract in held:
            return held.index(contract) + 1
        if held and (faults := backward_faults(held[-1], contract)):
            raise Incompatible(f"{subject(topic)}: " + "; ".join(faults))
        held.append(contract)
        return len(held)

    def bootstrap(self) -> dict[str, int]:
        return {subject(topic): max(self.register(topic, c) for c in versions) for topic, versions in CONTRACTS.items()}


def read_as(df: DataFrame, contract: Contract) -> DataFrame:
    """Records as the contract's reader sees them: missing fields take defaults, unknown ones go."""
    out = []
    for f in contract.schema:
        if f.name in df.columns:
            out.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.name in contract.defaults:
            out.append(F.lit(contract.defaults[f.name]).cast(f.dataType).alias(f.name))
        else:
            raise Incompatible(f"{f.name} is missing and has no default")
    return df.select(*out)


def out_of_domain(contract: Contract) -> Column:
    """Whether a row has a value that its field doesn't allow."""
    test = F.lit(False)
    for name, allowed in contract.domains.items():
        test = test | F.coalesce(~F.col(name).isin(*allowed), F.lit(False))
    return test


def refuse(df: DataFrame, fault: Column) -> DataFrame:
    """The rows; reading one with a fault fails."""
    return df.withColumn("_fault", F.when(fault, F.raise_error(F.lit("a value is out of its domain"))).cast("string")).where("_fault is null").drop("_fault")


def require_domain(df: DataFrame, contract: Contract) -> DataFrame:
    """The rows; reading one that is out of its domain fails, as writing it would."""
    return refuse(df, out_of_domain(contract))
