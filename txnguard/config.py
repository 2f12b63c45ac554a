"""All tunables in frozen dataclasses.

``ScoringConfig()`` carries the operating point of the original application
(windows, thresholds, weights); ``FixtureSpec`` carries the parameters used to
derive transactions and reference tables from the driver's ``events`` table.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import datetime

MICROS_PER_SECOND = 1_000_000


def duration_micros(text: str) -> int:
    """'30 seconds' / '1 minute' / '3 days' -> microseconds."""
    qty, unit = text.split()
    unit = unit.lower().rstrip("s")
    seconds = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 7 * 86400}[unit]
    return int(qty) * seconds * MICROS_PER_SECOND


@dataclass(frozen=True)
class RuleWeights:
    # Fixed values of the original rule set (score contributed when a rule fires).
    velocity: float = 0.35          # R1 HIGH_VELOCITY
    blacklist: float = 0.40         # R2 BLACKLIST_RECEIVER, scaled by severity / 5
    amount_anomaly: float = 0.30    # R3 AMOUNT_ANOMALY
    new_device: float = 0.15        # R4 NEW_DEVICE
    odd_hour: float = 0.20          # R5 ODD_HOUR_LARGE_TXN
    bl_velocity: float = 0.50       # R6 HIGH_BL_VELOCITY


@dataclass(frozen=True)
class ScoringConfig:
    # Fixed values of the original application: windows, limits, weights.
    short_window: str = "1 minute"
    short_slide: str = "30 seconds"
    long_window: str = "10 minutes"
    long_slide: str = "1 minute"
    watermark: str = "30 seconds"
    short_count_limit: int = 5          # txn_count_1m >= 5
    long_count_limit: int = 10          # txn_count_10m >= 10
    amount_ratio: float = 5.0           # amount > avg_amount * 5
    zscore_limit: float = 4.0           # amount_zscore > 4.0
    large_amount: float = 1_000_000.0   # amount > 1 000 000 (VND)
    odd_hour_from: int = 1              # hour_of_day between 1 and 5
    odd_hour_to: int = 5
    severity_scale: float = 5.0
    score_cap: float = 1.0
    weights: RuleWeights = field(default_factory=RuleWeights)
    rule_weight: float = 0.5            # final = 0.5 * rule + 0.5 * ml
    ml_weight: float = 0.5
    alert_threshold: float = 0.5        # final_fraud_score >= 0.5
    max_offsets_per_trigger: int = 100_000
    trigger_interval: str = "5 seconds"
    # Ours (not in the original): behaviour switches and scale knobs.
    velocity_mode: str = "trailing"     # "trailing" (per-row window) | "self" (count 1, placeholder)
    zero_std: str = "zero"              # "zero": z = 0 when stddev <= 0 or missing; "unit": divide by 1
    calendar_tz: str | None = None      # None: event_time is already wall-clock UTC
    allowed_lateness: str = "1 hour"    # stream: rows late by at most this have their full window; later ones are scored on what is held
    dedup_horizon: str = "1 hour"       # stream: a transaction id is remembered for this long after its first arrival
    velocity_bucket: str | None = None  # stream: time split of a sender's state; None -> 8 x long window
    velocity_slice: str | None = None   # batch: time split of a sender's running sums; None -> the long window
    broadcast_max_rows: int = 2_000_000  # dims at most this many rows ...
    broadcast_max_bytes: int = 50 * 1024 * 1024  # ... and this many data bytes are broadcast (original: 50 MB)

    @property
    def short_micros(self) -> int:
        return duration_micros(self.short_window)

    @property
    def long_micros(self) -> int:
        return duration_micros(self.long_window)

    @property
    def slice_micros(self) -> int:
        return duration_micros(self.velocity_slice) if self.velocity_slice else self.long_micros

    @property
    def lateness_micros(self) -> int:
        return duration_micros(self.allowed_lateness)

    @property
    def bucket_micros(self) -> int:
        b = duration_micros(self.velocity_bucket) if self.velocity_bucket else 8 * self.long_micros
        return max(b, self.long_micros, self.short_micros)

    def with_(self, **kw) -> "ScoringConfig":
        return replace(self, **kw)


@dataclass(frozen=True)
class FixtureSpec:
    """How transactions and reference tables are derived from ``events``."""

    score_from: datetime = datetime(2024, 1, 16)      # rows scored: event_time >= this
    history_before: datetime = datetime(2024, 1, 16)  # baseline / device history cutoff
    short_window: str = "1 day"
    long_window: str = "3 days"
    large_amount: float = 100.0
    blacklist_user_mod: int = 10        # users with user_id % 10 = 3 are blacklisted receivers
    blacklist_user_rem: int = 3
    baseline_skip_mod: int = 17         # user_id % 17 = 5 has no baseline (no-history path)
    baseline_skip_rem: int = 5
    fault_mod: int = 97                 # wire rows with event_id % 97 = 0 are corrupted (q02)
    duplicate_mod: int = 20             # wire rows with event_id % 20 = 0 are redelivered (q17)
    late_mod: int = 50                  # wire rows with event_id % 50 = 0 arrive in a later file

    def scoring(self, base: ScoringConfig | None = None) -> ScoringConfig:
        base = base or ScoringConfig()
        return base.with_(short_window=self.short_window, long_window=self.long_window,
                          large_amount=self.large_amount)


@dataclass(frozen=True)
class ModelConfig:
    # Fixed values of the original model: 10 numeric + 2 categorical features, GBT settings.
    numeric_features: tuple[str, ...] = (
        "amount", "txn_count_1m", "txn_count_10m", "total_amount_10m", "avg_amount_10m",
        "amount_zscore", "hour_of_day", "is_new_device", "is_weekend", "bl_receiver_severity",
    )
    categorical_features: tuple[str, ...] = ("txn_type", "channel")
    label: str = "isFraud"
    max_iter: int = 100
    max_depth: int = 6
    step_size: float = 0.1
    subsampling_rate: float = 0.8
    feature_subset: str = "sqrt"
    seed: int = 42
    # Ours.
    class_weighting: bool = True
    median_relative_error: float = 0.001
    severity_null: str = "median"       # "median" (as original) | "zero"
    cache_node_ids: bool = False        # MLlib option for deep trees (slower on small data)
