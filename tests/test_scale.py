"""Skew handling is exact: bucketed operators equal their unbucketed brute force,
with one sender owning a third of all rows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from txnguard.config import FixtureSpec
from txnguard.functions.expressions import epoch_micros
from txnguard.operators import ml
from txnguard.operators.enrich import validity_segments
from txnguard.operators.geo import previous_point
from txnguard.operators.velocity import trailing_velocity
from txnguard.sources import fixtures as fx

SPEC = FixtureSpec()
CFG = SPEC.scoring()


def hot_txn(spark):
    src = fx.transaction_source(spark, SF_SMALL)
    hot = F.when(F.col("event_id") % 3 == 0, F.lit("USER_HOT")).otherwise(F.col("sender_id"))
    return src.withColumn("sender_id", hot)


def brute_velocity(df, cfg):
    w = Window.partitionBy("sender_id").orderBy("_us")
    w1, w2 = w.rangeBetween(-cfg.short_micros, 0), w.rangeBetween(-cfg.long_micros, 0)
    return (df.withColumn("_us", epoch_micros("event_time"))
            .select("txn_id", F.count(F.lit(1)).over(w1).cast("int").alias("txn_count_1m"),
                    F.sum("amount").over(w1).alias("total_amount_1m"),
                    F.count(F.lit(1)).over(w2).cast("int").alias("txn_count_10m"),
                    F.sum("amount").over(w2).alias("total_amount_10m"),
                    F.stddev_samp("amount").over(w2).alias("stddev_amount_10m")))


def _rounded(df):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect())


def test_hot_sender_trailing_velocity_exact(spark):
    t = hot_txn(spark)
    cols = ["txn_id", "txn_count_1m", "total_amount_1m", "txn_count_10m", "total_amount_10m", "stddev_amount_10m"]
    expected = _rounded(brute_velocity(t, CFG).select(*cols))
    for piece in (None, "1 hour", "7 days"):
        got = _rounded(trailing_velocity(t, CFG.with_(velocity_slice=piece)).select(*cols))
        assert got == expected, piece


def test_one_window_of_one_sender_is_split(spark):
    """Most rows belong to one sender and lie inside one long window; slices far shorter than the window split
    them, the result is exact and the plan has no Python node."""
    t = hot_txn(spark).withColumn("event_time", F.when(
        F.col("sender_id") == "USER_HOT",
        F.expr("timestamp_ntz'2024-01-10 00:00:00' + make_dt_interval(0, 0, 0, event_id * 60.001)")).otherwise(F.col("event_time")))
    t = t.withColumn("sender_id", F.when(F.col("event_id") % 10 < 8, F.lit("USER_HOT")).otherwise(F.col("sender_id")))
    cols = ["txn_id", "txn_count_1m", "total_amount_1m", "txn_count_10m", "total_amount_10m", "stddev_amount_10m"]
    v = trailing_velocity(t, CFG.with_(velocity_slice="1 hour")).select(*cols)
    assert _rounded(v) == _rounded(brute_velocity(t, CFG).select(*cols))
    plan = v._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "hashpartitioning(sender_id" in plan


def test_null_amounts_and_times(spark):
    rows = [("a", "s", 1.0, 1), ("b", "s", None, 2), ("c", "s", 3.0, 3), ("d", "s", float("nan"), 4), ("e", None, 1.0, 5),
            ("f", "s", 1.0, None)]
    df = spark.createDataFrame(rows, "txn_id string, sender_id string, amount double, s int").withColumn(
        "event_time", F.expr("timestamp_ntz'2024-01-10 00:00:00' + make_dt_interval(0, 0, 0, s)")).drop("s")
    got = {r.txn_id: r for r in trailing_velocity(df, CFG).collect()}
    assert [got[k].txn_count_1m for k in "abcd"] == [1, 2, 3, 4]
    assert [got[k].total_amount_1m for k in "abcd"] == [1.0, 1.0, 4.0, 4.0]
    assert got["c"].avg_amount_10m == 2.0 and abs(got["c"].stddev_amount_10m - 2 ** 0.5) < 1e-12
    assert got["e"].txn_count_1m is None and got["f"].txn_count_1m is None and len(got) == 6


def test_bucketed_lag_equals_plain_lag(spark):
    t = hot_txn(spark)
    w = Window.partitionBy("sender_id").orderBy("event_time", "txn_id")
    expected = sorted(t.select("txn_id", F.lag("lat").over(w).alias("p"),
                               F.lag(epoch_micros("event_time")).over(w).alias("pu")).collect())
    for bucket in ("1 hour", "1 day", "7 days"):
        got = sorted(previous_point(t, bucket=bucket).select("txn_id", F.col("prev_lat").alias("p"),
                                                             F.col("prev_us").alias("pu")).collect())
        assert got == expected, bucket


def test_validity_segments_equal_brute_force(spark):
    bl = fx.blacklist_long(spark, SF_SMALL, SPEC)
    t = fx.transactions(spark, SF_SMALL).select("txn_id", "device_id", "event_time")
    b = bl.filter(F.col("entity_type") == "DEVICE")
    cond = ((t.device_id == b.entity_id) & (b.listed_at <= t.event_time)
            & (b.expires_at.isNull() | (t.event_time < b.expires_at)))
    expected = sorted(t.join(b, cond, "left").groupBy("txn_id").agg(F.max("severity").alias("s")).collect())
    seg = validity_segments(bl, "DEVICE")
    c2 = ((t.device_id == seg.entity_id) & (seg.seg_start <= t.event_time)
          & (seg.seg_end.isNull() | (t.event_time < seg.seg_end)))
    joined = t.join(seg, c2, "left")
    assert joined.count() == t.count()  # segments never overlap: no fan-out
    got = sorted(joined.select("txn_id", F.col("severity").alias("s")).collect())
    assert got == expected


def test_severities_are_taken_as_they_are(spark):
    """No scale is assumed: 0 and 7 stay, a null severity never becomes the worst one."""
    from txnguard.operators.enrich import enrich_with_blacklist, enrich_with_entity_blacklist_asof
    day = "timestamp_ntz'2024-01-{:02d} 00:00:00'"
    bl = spark.sql("select * from values " + ", ".join([
        f"('A', 'DEVICE', 7, {day.format(1)}, {day.format(9)})", f"('A', 'DEVICE', null, {day.format(1)}, null)",
        f"('B', 'DEVICE', 0, {day.format(1)}, null)", f"('C', 'DEVICE', null, {day.format(1)}, null)",
        f"('U', 'USER', 9, {day.format(1)}, {day.format(5)})"]) + " as t(entity_id, entity_type, severity, listed_at, expires_at)")
    txn = spark.sql("select * from values " + ", ".join(
        f"('{d}{n}', '{d}', 'x', 'U', {day.format(n)})" for d in "ABC" for n in (3, 10)) +
        " as t(txn_id, device_id, ip_address, receiver_id, event_time)")
    got = {r.txn_id: r.bl_device_severity for r in enrich_with_entity_blacklist_asof(txn, bl, CFG).collect()}
    assert got == {"A3": 7, "A10": None, "B3": 0, "B10": 0, "C3": None, "C10": None}
    users = {r.txn_id: r.bl_receiver_severity for r in enrich_with_blacklist(txn, bl, CFG).collect()}
    assert users == {k: 9 if k.endswith("3") else None for k in got}  # the expired listing no longer counts


def test_first_delivery_never_merges_rows_without_key(spark):
    from txnguard.sources.wire import first_delivery
    df = spark.createDataFrame([(None, 1)] * 6 + [("a", 2), ("a", 1)], "txn_id string, kafka_ts int")
    got = sorted(tuple(r) for r in first_delivery(df).filter("txn_id is not null").collect())
    assert got == [("a", 1, 2)] and first_delivery(df).filter("txn_id is null").count() == 6


def test_auto_geo_bucket_narrows_for_hot_sender(spark):
    from txnguard.operators.geo import DAY_MICROS, MINUTE_MICROS, bucket_width
    t = hot_txn(spark)
    assert bucket_width(t) == DAY_MICROS
    w = bucket_width(t, target_rows=4)
    assert MINUTE_MICROS <= w < DAY_MICROS
    w_all = Window.partitionBy("sender_id").orderBy("event_time", "txn_id")
    expected = sorted(t.select("txn_id", F.lag("lat").over(w_all).alias("p")).collect())
    got = sorted(previous_point(t, target_rows=4).select("txn_id", F.col("prev_lat").alias("p")).collect())
    assert got == expected


def test_pr_auc_frame_matches_mllib(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    src = fx.transaction_source(spark, SF_SMALL)
    df = src.select((F.col("amount") / F.lit(500.0)).alias("score"), ml.fraud_label().alias("label"))
    expected = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label",
                                             metricName="areaUnderPR", numBins=0).evaluate(df)
    for bins in (4, 1024):
        got = ml.pr_auc_frame(df, "score", "label", bins=bins).first()["pr_auc"]
        assert abs(got - expected) < 1e-9, bins


def test_pr_auc_frame_clustered_scores(spark):
    """A third of the rows carry distinct scores packed into a 1e-9 wide interval
    (one fixed-width bin would hold them all); the ranged version is still exact."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    src = fx.transaction_source(spark, SF_SMALL)
    hot = F.col("event_id") % 3 == 0
    s = F.when(hot, F.lit(0.5) + F.col("event_id") * F.lit(1e-12)).otherwise(F.col("amount") / F.lit(500.0))
    df = src.select(s.alias("score"), ml.fraud_label().alias("label"))
    expected = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label",
                                             metricName="areaUnderPR", numBins=0).evaluate(df)
    got = ml.pr_auc_frame(df, "score", "label", bins=16).first()
    assert abs(got["pr_auc"] - expected) < 1e-9
    assert got["n_pos"] + got["n_neg"] == src.count()


def test_tree_path_equals_gather_path():
    import numpy as np
    from txnguard.functions.frames import frame_stats
    rng = np.random.default_rng(7)
    n = 5000
    snd = rng.integers(0, 5, n).astype(str).astype(object)
    ts = np.sort(rng.integers(0, 10 ** 8, n))
    amt = np.round(rng.uniform(0, 500, n), 2)
    amt[::5] = 42.0
    a = frame_stats(snd, ts, amt, snd, ts, 10 ** 7)
    b = frame_stats(snd, ts, amt, snd, ts, 10 ** 7, gather_limit=0)
    assert np.array_equal(a[0], b[0])
    for x, y in zip(a[1:], b[1:]):
        assert np.allclose(x, y, rtol=1e-12, atol=1e-9, equal_nan=True)
