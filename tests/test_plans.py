"""Physical plan checks: broadcast joins behind the size check, one shuffle for
velocity, no Python evaluation in the scoring path, pushdown and pruning."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from txnguard.config import FixtureSpec
from txnguard.plans.catalog import q12_trailing_velocity, refs
from txnguard.plans.scoring import alerts, score
from txnguard.sources import fixtures as fx
from txnguard.sources.reference import build_baseline, read_snapshot, write_snapshot

SPEC = FixtureSpec()


def plan_of(df) -> str:
    """Executed plan; for an adaptive plan only its final part."""
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_scoring_plan_broadcasts_and_stays_in_jvm(spark):
    s = alerts(score(fx.transaction_source(spark, SF_SMALL), refs(spark, SF_SMALL), SPEC.scoring(),
                     score_from=SPEC.score_from))
    s.collect()  # final adaptive plan
    p = plan_of(s)
    assert p.count("BroadcastHashJoin") >= 3
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert "SortMergeJoin" not in p


def test_large_dimension_is_not_broadcast(spark):
    cfg = SPEC.scoring().with_(broadcast_max_rows=1)
    s = score(fx.transaction_source(spark, SF_SMALL), refs(spark, SF_SMALL), cfg, score_from=SPEC.score_from)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        s.collect()
        assert "BroadcastHashJoin" not in plan_of(s)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_dimension_over_byte_bound_is_not_broadcast(spark):
    from txnguard.operators.dims import payload_bytes, sized_dimension
    df = spark.createDataFrame([("abc", 1.0, 2), ("de", None, 3)], "k string, x double, n int")
    assert df.agg(payload_bytes(df)).first()[0] == 2 * (16 + 8 + 4) + 5
    nested = spark.createDataFrame([(["ab", "c"],)], "a array<string>")
    assert nested.agg(payload_bytes(nested)).first()[0] == 16 + len('["ab","c"]')
    cfg = SPEC.scoring().with_(broadcast_max_bytes=1)
    s = score(fx.transaction_source(spark, SF_SMALL), refs(spark, SF_SMALL), cfg, score_from=SPEC.score_from)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        s.collect()
        assert "BroadcastHashJoin" not in plan_of(s)
        hinted = sized_dimension(df, 10, materialize_first=False, max_bytes=10 ** 6)
        assert "BroadcastHashJoin" in plan_of(df.join(hinted, "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_snapshot_references_joined_without_copy(spark, workdir):
    from txnguard.plans.scoring import ReferenceTables, join_dimensions
    from txnguard.sources.reference import read_snapshot, write_snapshot
    r = refs(spark, SF_SMALL)
    for name, df in (("baseline", r.baseline), ("devices", r.devices)):
        write_snapshot(df, f"{workdir}/{name}", "2024-01-16")
    snap = ReferenceTables(r.blacklist, read_snapshot(spark, f"{workdir}/baseline", "2024-01-16"),
                           read_snapshot(spark, f"{workdir}/devices", "2024-01-16"), snapshots=True)
    dims = join_dimensions(snap, SPEC.scoring())
    assert dims.baseline.inputFiles() and dims.devices.inputFiles()
    assert all(f"{workdir}/baseline/" in f for f in dims.baseline.inputFiles())
    assert all(f"{workdir}/devices/" in f for f in dims.devices.inputFiles())
    s = score(fx.transaction_source(spark, SF_SMALL), dims, SPEC.scoring(), score_from=SPEC.score_from)
    b = score(fx.transaction_source(spark, SF_SMALL), r, SPEC.scoring(), score_from=SPEC.score_from)
    assert sorted(s.select("txn_id", "fraud_rule_score").collect()) == \
        sorted(b.select("txn_id", "fraud_rule_score").collect())


def test_history_filter_pushed_to_scan(spark):
    s = score(fx.transaction_source(spark, SF_SMALL), refs(spark, SF_SMALL), SPEC.scoring(),
              score_from=SPEC.score_from)
    p = s._jdf.queryExecution().sparkPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-13T00:00)" in p


def test_velocity_reads_only_needed_columns(spark):
    df = q12_trailing_velocity(spark, SF_SMALL)
    p = df._jdf.queryExecution().sparkPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in p
    plan = plan_of(df)
    assert "hashpartitioning(sender_id" in plan and "Python" not in plan and "Pandas" not in plan


def test_snapshot_read_prunes_partitions(spark, workdir):
    t = fx.transactions(spark, SF_SMALL)
    path = f"{workdir}/baseline"
    write_snapshot(build_baseline(t.filter(F.col("event_time") < "2024-01-10")), path, "2024-01-10")
    write_snapshot(build_baseline(t.filter(F.col("event_time") < "2024-01-16")), path, "2024-01-16")
    b = read_snapshot(spark, path, "2024-01-16")
    p = b._jdf.queryExecution().sparkPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in p
    assert b.count() == build_baseline(t.filter(F.col("event_time") < "2024-01-16")).count()
