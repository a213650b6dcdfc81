"""Check thresholds, each overridable through an environment variable FAREMILL_<NAME>."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Thresholds:
    # Default limits of the data-quality checks.
    volume_min: int = 5_000
    volume_max: int = 5_000_000
    raw_drift_max: float = 0.05
    null_pickup_area_max: float = 0.5
    speed_mph_max: float = 150.0
    tip_pct_max: float = 2.0
    volume_drift_max: float = 0.1
    revenue_tolerance: float = 0.01
    stale_after_hours: int = 30

    @classmethod
    def from_env(cls, env=os.environ) -> "Thresholds":
        given = {}
        for field in fields(cls):
            text = env.get(f"FAREMILL_{field.name.upper()}", "").strip()
            if text:
                given[field.name] = type(field.default)(text)
        return cls(**given)
