"""Tunable values, gathered in small frozen dataclasses."""

from __future__ import annotations

from dataclasses import dataclass

# A single window task sorts at most about this many rows; beyond it a unit's run is split.
MAX_RUN_ROWS = 2_000_000

# A side of a few narrow columns may be broadcast only when a count has shown it to hold no
# more rows than this.
MAX_BROADCAST_ROWS = 500_000


@dataclass(frozen=True)
class ShieldSettings:
    """Thresholds of the quality rules."""

    # The limits the rules are defined with.
    watermark: str = "10 seconds"
    max_age_seconds: int = 3600
    sla_seconds: int = 300
    rotor_threshold: float = 2000.0
    freeze_horizon: int = 5
    required_readings: tuple[str, ...] = ("htBleed",)

    max_run_rows: int = MAX_RUN_ROWS

    def __post_init__(self) -> None:
        if self.freeze_horizon < 2:
            raise ValueError("freeze_horizon must be at least 2")
        if self.max_age_seconds < 0 or self.sla_seconds < 0:
            raise ValueError("ages must not be negative")


@dataclass(frozen=True)
class MartSettings:
    """Limits of the warehouse models."""

    # Exhaust temperature limit and moving average frame.
    egt_limit: float = 1450.0
    frame_rows: int = 10

    max_run_rows: int = MAX_RUN_ROWS


@dataclass(frozen=True)
class FlightSettings:
    """Ranges the flight clock draws from; both ends are inclusive."""

    # Defaults of the fleet.
    hz: int = 100
    min_duration_sec: int = 120
    max_duration_sec: int = 300
    idle_min_sec: int = 15
    idle_max_sec: int = 30
    noise_scale: float = 0.0001

    seed: str = "fleet"

    def __post_init__(self) -> None:
        if not 0 < self.min_duration_sec <= self.max_duration_sec:
            raise ValueError("need 0 < min_duration_sec <= max_duration_sec")
        if not 0 <= self.idle_min_sec <= self.idle_max_sec:
            raise ValueError("need 0 <= idle_min_sec <= idle_max_sec")
        if self.hz <= 0:
            raise ValueError("hz must be positive")
