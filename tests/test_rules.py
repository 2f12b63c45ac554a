"""Golden rule vectors (hand-computed from the original rule set, default constants)."""

import pytest
from pyspark.sql import Row

from txnguard.config import ScoringConfig
from txnguard.functions.expressions import zscore, zscore_unit
from txnguard.operators.rules import apply_rules, blend, flags_text

BASE = dict(amount=500_000.0, avg_amount=1_000_000.0, stddev_amount=500_000.0, bl_receiver_severity=None,
            is_new_device=0, hour_of_day=10, txn_count_1m=1, txn_count_10m=1)

CASES = [
    ("base", {}, 0.0),
    ("blacklist 5", {"bl_receiver_severity": 5}, 0.40),
    ("blacklist 1", {"bl_receiver_severity": 1}, 0.08),
    ("fraud-like", {"amount": 12_000_000.0, "bl_receiver_severity": 5, "is_new_device": 1}, 0.85),
    ("z exactly 4", {"amount": 3_000_000.0}, 0.0),
    ("z just over", {"amount": 3_000_001.0}, 0.30),
    ("hour 1", {"hour_of_day": 1, "amount": 1_000_001.0}, 0.20),
    ("hour 5", {"hour_of_day": 5, "amount": 1_000_001.0}, 0.20),
    ("hour 0", {"hour_of_day": 0, "amount": 1_000_001.0}, 0.0),
    ("hour 6", {"hour_of_day": 6, "amount": 1_000_001.0}, 0.0),
    ("amount not large", {"hour_of_day": 3, "amount": 1_000_000.0}, 0.0),
    ("velocity 5", {"txn_count_1m": 5}, 0.35),
    ("velocity 4", {"txn_count_1m": 4}, 0.0),
    ("listed velocity", {"txn_count_10m": 10, "bl_receiver_severity": 3}, 0.74),
    ("no baseline", {"avg_amount": None, "stddev_amount": None, "amount": 50_000_000.0}, 0.0),
    ("zero stddev", {"stddev_amount": 0.0, "amount": 6_000_000.0}, 0.30),
    ("new device", {"is_new_device": 1}, 0.15),
    ("all six", {"txn_count_1m": 5, "txn_count_10m": 10, "bl_receiver_severity": 5, "amount": 12_000_000.0,
                 "is_new_device": 1, "hour_of_day": 3}, 1.0),
]


@pytest.fixture(scope="module")
def scored(spark):
    rows = [Row(case=name, **{**BASE, **change}) for name, change, _ in CASES]
    schema = ("case string, amount double, avg_amount double, stddev_amount double, bl_receiver_severity int, "
              "is_new_device int, hour_of_day int, txn_count_1m int, txn_count_10m int")
    df = spark.createDataFrame([tuple(r[c] for c in ["case", *BASE]) for r in rows], schema)
    df = df.withColumn("amount_zscore", zscore())
    out = apply_rules(df, ScoringConfig())
    return {r["case"]: r for r in out.select("case", "fraud_rule_score", "rule_flags",
                                             flags_text().alias("ft")).collect()}


@pytest.mark.parametrize("name,change,expected", CASES)
def test_golden_vector(scored, name, change, expected):
    assert round(scored[name]["fraud_rule_score"], 6) == pytest.approx(expected)


def test_flags_keep_positions(scored):
    assert scored["base"]["rule_flags"] == [None] * 6
    assert scored["all six"]["ft"] == ("HIGH_VELOCITY|BLACKLIST_RECEIVER|AMOUNT_ANOMALY|NEW_DEVICE|"
                                      "ODD_HOUR_LARGE_TXN|HIGH_BL_VELOCITY")
    assert scored["fraud-like"]["ft"] == "-|BLACKLIST_RECEIVER|AMOUNT_ANOMALY|NEW_DEVICE|-|-"


def test_blend_threshold(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.40, 0.59)], "fraud_rule_score double, ml_fraud_score double")
    out = [round(r[0], 6) for r in blend(df, ScoringConfig()).select("final_fraud_score").collect()]
    assert out == [0.5, 0.495]


def test_two_zscores(spark):
    df = spark.createDataFrame([(6.0, 1.0, 0.0), (6.0, None, None)], "amount double, avg_amount double, stddev_amount double")
    r = df.select(zscore().alias("z0"), zscore_unit().alias("z1")).collect()
    assert (r[0]["z0"], r[0]["z1"]) == (0.0, 5.0)
    assert (r[1]["z0"], r[1]["z1"]) == (0.0, None)
