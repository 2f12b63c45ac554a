"""Weighted rule scoring.

Rules are data (name, flag label, condition, score); ``apply_rules`` compiles the
whole set into one projection: six component columns, the capped score and the
6-slot flag array (label where the rule fired, null elsewhere).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnguard.config import ScoringConfig


@dataclass(frozen=True)
class Rule:
    name: str
    flag: str
    condition: Column
    score: Column


def default_rules(cfg: ScoringConfig = ScoringConfig()) -> list[Rule]:
    w = cfg.weights
    sev = F.col("bl_receiver_severity")
    amount = F.col("amount")
    return [
        Rule("r1_velocity", "HIGH_VELOCITY",
             F.col("txn_count_1m") >= cfg.short_count_limit, F.lit(w.velocity)),
        Rule("r2_blacklist", "BLACKLIST_RECEIVER",
             sev.isNotNull(), (sev / F.lit(cfg.severity_scale)) * F.lit(w.blacklist)),
        Rule("r3_amount_anomaly", "AMOUNT_ANOMALY",
             (amount > F.col("avg_amount") * F.lit(cfg.amount_ratio))
             | (F.col("amount_zscore") > F.lit(cfg.zscore_limit)), F.lit(w.amount_anomaly)),
        Rule("r4_new_device", "NEW_DEVICE",
             F.col("is_new_device") == 1, F.lit(w.new_device)),
        Rule("r5_odd_hour", "ODD_HOUR_LARGE_TXN",
             F.col("hour_of_day").between(cfg.odd_hour_from, cfg.odd_hour_to)
             & (amount > F.lit(cfg.large_amount)), F.lit(w.odd_hour)),
        Rule("r6_bl_velocity", "HIGH_BL_VELOCITY",
             (F.col("txn_count_10m") >= cfg.long_count_limit) & sev.isNotNull(), F.lit(w.bl_velocity)),
    ]


def apply_rules(df: DataFrame, cfg: ScoringConfig = ScoringConfig(),
                rules: list[Rule] | None = None) -> DataFrame:
    """+ one column per rule, ``fraud_rule_score`` = least(cap, sum left to right),
    ``rule_flags`` array<string> with nulls for rules that did not fire."""
    rules = rules or default_rules(cfg)
    df = df.withColumns({r.name: F.when(r.condition, r.score).otherwise(F.lit(0.0)) for r in rules})
    total = F.col(rules[0].name)
    for r in rules[1:]:
        total = total + F.col(r.name)
    return df.withColumns({
        "fraud_rule_score": F.least(F.lit(cfg.score_cap), total),
        "rule_flags": F.array(*[F.when(F.col(r.name) > 0, F.lit(r.flag)) for r in rules]),
    })


def flags_text(col: str = "rule_flags", sep: str = "|", null_text: str = "-") -> Column:
    """Flag array rendered as text, nulls kept as ``null_text`` (positions visible)."""
    return F.array_join(F.col(col), sep, null_text)


def blend(df: DataFrame, cfg: ScoringConfig = ScoringConfig(), has_model: bool = True) -> DataFrame:
    """final_fraud_score = rule_weight * rule + ml_weight * ml (rule only without model)."""
    if has_model:
        final = F.col("fraud_rule_score") * F.lit(cfg.rule_weight) + F.col("ml_fraud_score") * F.lit(cfg.ml_weight)
    else:
        final = F.col("fraud_rule_score")
    out = df if has_model else df.withColumn("ml_fraud_score", F.lit(None).cast("double"))
    return out.withColumn("final_fraud_score", final)
