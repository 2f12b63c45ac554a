"""Properties of the scoring plan on the driver tables."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from txnguard.config import FixtureSpec
from txnguard.operators.enrich import enrich_with_baseline, enrich_with_blacklist, enrich_with_device
from txnguard.plans.catalog import refs
from txnguard.plans.scoring import alerts, safe_rows, score
from txnguard.sources import fixtures as fx

SPEC = FixtureSpec()
CFG = SPEC.scoring()


@pytest.fixture(scope="module")
def scored(spark):
    return score(fx.transaction_source(spark, SF_SMALL), refs(spark, SF_SMALL), CFG,
                 score_from=SPEC.score_from).persist()


def test_scores_bounded(scored):
    r = scored.agg(F.min("fraud_rule_score"), F.max("fraud_rule_score"),
                   F.sum(F.col("fraud_rule_score").isNull().cast("int"))).first()
    assert 0.0 <= r[0] and r[1] <= 1.0 and r[2] == 0


def test_alerts_and_safe_partition_the_scored_rows(scored):
    a = alerts(scored, CFG).select("txn_id")
    s = safe_rows(scored, CFG).select("txn_id")
    assert a.count() + s.count() == scored.count() == 480
    assert a.join(s, "txn_id").count() == 0


def test_enrichment_preserves_rows(spark):
    t = fx.transactions(spark, SF_SMALL)
    n = t.count()
    # duplicate blacklist rows must not fan transactions out
    bl = fx.blacklist_users(spark, SF_SMALL, SPEC)
    doubled = bl.unionByName(bl.withColumn("severity", F.col("severity") + 1))
    assert enrich_with_blacklist(t, doubled, CFG).count() == n
    assert enrich_with_baseline(t, fx.baseline(spark, SF_SMALL, SPEC), CFG).count() == n
    assert enrich_with_device(t, fx.known_devices(spark, SF_SMALL, SPEC), CFG).count() == n


def test_fixture_counts_match_fixtures_doc(scored):
    c = scored.agg(*[F.sum((F.col(r) > 0).cast("int")).alias(r) for r in
                     ("r1_velocity", "r2_blacklist", "r3_amount_anomaly", "r4_new_device",
                      "r5_odd_hour", "r6_bl_velocity")],
                   F.sum(F.col("avg_amount").isNull().cast("int")).alias("no_baseline"),
                   F.sum("is_weekend").alias("weekend")).first().asDict()
    assert c == {"r1_velocity": 77, "r2_blacklist": 58, "r3_amount_anomaly": 5, "r4_new_device": 356,
                 "r5_odd_hour": 13, "r6_bl_velocity": 8, "no_baseline": 30, "weekend": 124}


def test_deterministic_rerun(spark, scored):
    again = score(fx.transaction_source(spark, SF_SMALL), refs(spark, SF_SMALL), CFG, score_from=SPEC.score_from)
    cols = ["txn_id", "fraud_rule_score"]
    assert sorted(scored.select(*cols).collect()) == sorted(again.select(*cols).collect())
