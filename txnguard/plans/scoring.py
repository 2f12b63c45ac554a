"""The end-to-end scoring plan, shared by batch and the streaming job.

velocity (needs the sender's recent history) -> restrict to the rows to score ->
blacklist -> baseline + z-score -> known device + calendar -> [model] -> rules ->
blend. Every step is a DataFrame operator, so Catalyst sees one plan.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.config import ModelConfig, ScoringConfig
from txnguard.functions.expressions import ntz_literal
from txnguard.operators.enrich import (
    SegmentDimension, add_calendar, baseline_dimension, blacklist_dimension, device_dimension, enrich_with_baseline,
    enrich_with_blacklist, enrich_with_device,
)
from txnguard.operators.rules import apply_rules, blend
from txnguard.operators.velocity import self_velocity, trailing_velocity
from txnguard.schemas import OUTPUT_COLUMNS


@dataclass
class ReferenceTables:
    blacklist: DataFrame     # entity_id, entity_type, severity [, listed_at, expires_at]
    baseline: DataFrame      # user_id, avg_amount, stddev_amount
    devices: DataFrame       # user_id, device_id
    snapshots: bool = False  # already stable files (e.g. read_snapshot): joined without a copy


@dataclass
class JoinDimensions:
    """Join-ready, size-checked sides of J1-J3 (prepared once, reused by many plans,
    e.g. every micro-batch of the streaming job until the references refresh)."""
    blacklist: DataFrame | SegmentDimension  # _bl_key, bl_receiver_severity; or validity segments
    baseline: DataFrame      # _b_user, avg_amount, stddev_amount
    devices: DataFrame       # _d_user, _d_dev, _d_known


def join_dimensions(refs: ReferenceTables, cfg: ScoringConfig = ScoringConfig(),
                    materialize: bool = True) -> JoinDimensions:
    """Baseline and devices are projections: when they come from stable snapshots
    they are size-checked from the source and joined without a copy. The blacklist
    is reduced by an aggregate, so it is written once either way."""
    copy = materialize and not refs.snapshots
    return JoinDimensions(blacklist_dimension(refs.blacklist, cfg, materialize=materialize),
                          baseline_dimension(refs.baseline, cfg, copy),
                          device_dimension(refs.devices, cfg, copy))


def history_start(score_from: datetime, cfg: ScoringConfig) -> datetime:
    """Rows before this cannot reach any trailing window of a scored row."""
    return score_from - timedelta(microseconds=max(cfg.long_micros, cfg.short_micros))


def features(txn: DataFrame, refs: ReferenceTables | JoinDimensions, cfg: ScoringConfig = ScoringConfig(),
             score_from: datetime | None = None, materialize: bool = True) -> DataFrame:
    """Transactions + every feature the rules and the model read.

    With ``score_from`` only rows at or after it are returned; history before it is
    read only as far back as the longest trailing window (filter reaches the scan).
    """
    ts = F.col("event_time").cast("timestamp_ntz")
    if cfg.velocity_mode == "given":  # velocity columns computed upstream (streaming state)
        df = txn if score_from is None else txn.filter(ts >= ntz_literal(score_from))
    elif cfg.velocity_mode == "trailing":
        if score_from is not None:
            txn = txn.filter(ts >= ntz_literal(history_start(score_from, cfg)))
        df = trailing_velocity(txn, cfg)
        if score_from is not None:
            df = df.filter(ts >= ntz_literal(score_from))
    else:
        df = txn if score_from is None else txn.filter(ts >= ntz_literal(score_from))
    dims = refs if isinstance(refs, JoinDimensions) else join_dimensions(refs, cfg, materialize)
    df = enrich_with_blacklist(df, None, cfg, dim=dims.blacklist)
    df = enrich_with_baseline(df, None, cfg, dim=dims.baseline)
    df = enrich_with_device(df, None, cfg, dim=dims.devices)
    df = add_calendar(df, cfg)
    if cfg.velocity_mode == "self":
        df = self_velocity(df)
    return df


def score(txn: DataFrame, refs: ReferenceTables | JoinDimensions, cfg: ScoringConfig = ScoringConfig(),
          model=None, score_from: datetime | None = None, materialize: bool = True,
          mcfg: ModelConfig = ModelConfig()) -> DataFrame:
    """All scored rows with rule components, fraud_rule_score, rule_flags,
    ml_fraud_score (null without model) and final_fraud_score."""
    df = features(txn, refs, cfg, score_from, materialize)
    if model is not None:
        from txnguard.operators.ml import score_with_model
        df = score_with_model(df, model, mcfg)
    df = apply_rules(df, cfg)
    return blend(df, cfg, has_model=model is not None)


def alerts(scored: DataFrame, cfg: ScoringConfig = ScoringConfig(), more: tuple[str, ...] = ()) -> DataFrame:
    """Rows with final_fraud_score >= threshold, 13-column output projection (and ``more`` columns after it)."""
    return scored.filter(F.col("final_fraud_score") >= F.lit(cfg.alert_threshold)).select(*OUTPUT_COLUMNS, *more)


def safe_rows(scored: DataFrame, cfg: ScoringConfig = ScoringConfig()) -> DataFrame:
    """Complement of ``alerts``: rows below the threshold (null scores count as safe)."""
    return scored.filter(~F.coalesce(F.col("final_fraud_score") >= F.lit(cfg.alert_threshold),
                                     F.lit(False))).select(*OUTPUT_COLUMNS)
