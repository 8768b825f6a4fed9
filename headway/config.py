"""Thresholds and constants of the telemetry domain. Fixed values, one dataclass for each part of the pipeline."""

from __future__ import annotations

from dataclasses import dataclass

LOCAL_ZONE = "America/Los_Angeles"


@dataclass(frozen=True)
class Bounds:
    """Positions outside (inclusive bounds) are quarantined."""

    min_lon: float = -122.60
    min_lat: float = 47.10
    max_lon: float = -121.05
    max_lat: float = 47.85


@dataclass(frozen=True)
class Enrichment:
    max_deviation_s: int = 10_800
    zone: str = LOCAL_ZONE
    #: "midnight" (local wall clock) or "noon_minus_12h" (differs on the two days a year that clocks change)
    origin: str = "midnight"


@dataclass(frozen=True)
class Bunching:
    gap_ft: float = 1000.0
    max_age_s: int = 90
    window_s: int = 60
    lateness_s: int = 360
    cooldown_s: int = 600
    min_consecutive: int = 2
    min_progress_ft: float = 100.0
    min_stop_sequence: int = 4
    proximity_margin: float = 1.25


@dataclass(frozen=True)
class Accuracy:
    window_s: int = 3600
    ttl_s: int = 5400
    cap: int = 120
    keep_negative_lead: bool = True
    watermark_s: int = 360
    bounds: tuple = (0, 120, 300, 600, 900, 1200, 1800, 2700)
    labels: tuple = ("past", "0-2m", "2-5m", "5-10m", "10-15m", "15-20m", "20-30m", "30-45m", "45-60m")


@dataclass(frozen=True)
class Warehouse:
    stale_lag_s: int = 3600
    late_s: int = 300
    health_lookback_h: int = 6
    alert_lookback_min: int = 15
    unplaced_days: int = 2
    stall_alert_min: int = 5
    stall_window_min: int = 70
    dlq_chronic_per_h: int = 8000
    peak_hours: tuple = (16, 17, 18)
    retention_days: int = 90


@dataclass(frozen=True)
class RunSettings:
    """Where a run reads and writes. A replay writes only below names of its own."""

    mode: str = "live"
    source: str = "enriched"
    target: str = "alerts"
    min_stop_sequence: int = Bunching.min_stop_sequence

    def __post_init__(self):
        if self.mode not in ("live", "baseline", "variant"):
            raise ValueError(f"unknown mode {self.mode!r}")
        if self.mode == "live" and (self.target.startswith("replay.") or self.source.startswith("replay.")):
            raise ValueError("a live run must not touch replay names")
        if self.mode != "live" and not (self.target.startswith("replay.") and self.source.startswith("replay.")):
            raise ValueError("a replay must stay below replay.*")
        if self.mode == "baseline" and self.min_stop_sequence != 0:
            raise ValueError("the baseline runs without the stop sequence gate")
        if self.mode == "variant" and self.min_stop_sequence <= 0:
            raise ValueError("the variant needs a stop sequence gate")
