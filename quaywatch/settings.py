"""Settings from the environment, with defaults."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Settings:
    """Field x is read from QUAYWATCH_X."""

    servers: str = "localhost:9092"
    bronze: str = "data/bronze"
    silver: str = "data/silver"
    gold: str = "data/gold"
    raw: str = "data/raw"
    wait_s: int = 10
    dedupe_horizon_s: int = 180
    window_s: int = 60
    replay_speed: float = 60.0

    @classmethod
    def load(cls, env: dict[str, str] | None = None) -> Settings:
        env = os.environ if env is None else env
        kinds = {"str": str, "int": int, "float": float}
        return cls(**{f.name: kinds[f.type](env[k]) for f in fields(cls) if (k := f"QUAYWATCH_{f.name.upper()}") in env})
