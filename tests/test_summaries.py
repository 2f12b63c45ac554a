"""Panes, daily moments, batch tables and velocity from summaries a second."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tests.conftest import SF_SMALL
from txnguard.config import FixtureSpec, ScoringConfig
from txnguard.operators.velocity import sliding_velocity, trailing_velocity
from txnguard.plans.catalog import _velocity_out
from txnguard.sources import fixtures as fx
from txnguard.sources.reference import (
    amount_moments, baseline_of_moments, build_baseline, merge_moments, new_day, read_snapshot, refresh_baseline, write_history,
)
from txnguard.streaming.batch_tables import BatchTable
from txnguard.streaming.job import first_deliveries
from txnguard.streaming.second_sums import ROWS, SecondSums

SPEC = FixtureSpec()
CFG = SPEC.scoring()


def rounded(df, *cols):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in (df.select(*cols) if cols else df).collect())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_panes_equal_spark_windows(spark):
    t = fx.transactions(spark, SF_SMALL)
    odd = spark.createDataFrame([("S", None), ("S", 1e9 + 0.125), ("S", 1e9 + 0.375), ("T", None)], "sender_id string, amount double")
    t = t.select("sender_id", "amount", "event_time").unionByName(odd.withColumn("event_time", F.lit("2024-01-10 10:00:30").cast("timestamp_ntz")))
    for size, slide in (("1 minute", "30 seconds"), ("10 minutes", "1 minute"), ("3 days", "6 hours"), ("1 day", "1 day")):
        plain = (t.groupBy("sender_id", F.window("event_time", size, slide))
                 .agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("s"), F.avg("amount").alias("a"), F.stddev_samp("amount").alias("d"))
                 .select("sender_id", F.col("window.end").alias("e"), "n", "s", "a", "d"))
        got = sliding_velocity(t, size, slide, "10m", full=True)
        assert rounded(got) == rounded(plain)


def test_panes_cross_the_exchange_once(spark):
    """The row-multiplying step stands above every exchange: a pane's row is shuffled, not its ten windows."""
    v = sliding_velocity(fx.transactions(spark, SF_SMALL), "10 minutes", "1 minute", "10m", full=True)
    plan = plan_of(v)
    assert "Expand" not in plan and plan.index("Generate") < plan.index("Exchange") and plan.count("Exchange hashpartitioning") == 2


def test_only_the_payment_row_carries_its_columns(spark):
    """What takes a payment back is shuffled without the payment's columns."""
    v = trailing_velocity(fx.transactions(spark, SF_SMALL), CFG)
    plan = v._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN ((_v#" in plan and v.columns[:16] == fx.transactions(spark, SF_SMALL).columns
    assert sorted(v.select("txn_id").collect()) == sorted(fx.transactions(spark, SF_SMALL).select("txn_id").collect())


def test_daily_refresh_equals_the_whole_history(spark, workdir):
    hist = fx.history(fx.transactions(spark, SF_SMALL), SPEC)
    hist = hist.unionByName(hist.limit(3).withColumns({"sender_id": F.lit("NULLS"), "amount": F.lit(None).cast("double")}))
    write_history(hist, workdir + "/h")
    days = sorted(r[0] for r in spark.read.parquet(workdir + "/h").select(F.col("event_date").cast("string")).distinct().collect())
    for previous, day in zip([None, *days], days):
        refresh_baseline(spark, workdir + "/h", workdir + "/m", day, previous)
    last = read_snapshot(spark, workdir + "/m", days[-1])
    plain = {r.user_id: r for r in build_baseline(hist).collect()}
    got = {r.user_id: r for r in baseline_of_moments(last).collect()}
    near = lambda a, b: a == b or abs(a - b) <= 1e-9 * abs(b)
    assert got.keys() == plain.keys()
    assert [(r, plain[u]) for u, r in got.items() if not (r.n_txn == plain[u].n_txn and near(r.avg_amount, plain[u].avg_amount)
                                                          and near(r.stddev_amount, plain[u].stddev_amount))] == []
    before = rounded(last)
    refresh_baseline(spark, workdir + "/h", workdir + "/m", days[-1], days[-2])  # again: replaces, adds nothing
    assert rounded(read_snapshot(spark, workdir + "/m", days[-1])) == before
    plan = plan_of(new_day(spark, workdir + "/h", days[-1]).agg(F.count("amount")))
    assert "PartitionFilters: [isnotnull(event_date" in plan
    step = merge_moments(read_snapshot(spark, workdir + "/m", days[-2]).unionByName(amount_moments(new_day(spark, workdir + "/h", days[-1]))))
    scans = [x.split("PushedFilters")[0] for x in plan_of(step).split("FileScan parquet")[1:]]
    assert len(scans) == 2 and all("PartitionFilters: [isnotnull(" in x for x in scans)  # one snapshot and one day
    assert "(snapshot_date" in scans[0] and days[-2] in scans[0] and "(event_date" in scans[1] and days[-1] in scans[1]


SCHEMA = StructType().add("v", "long").add("date", "string")


def numbers(spark, *values):
    return spark.createDataFrame([(v, f"2024-01-{1 + v % 3:02d}") for v in values], "v long, date string")


def held(table, **kw):
    return sorted(r.v for r in table.read(SCHEMA, **kw).collect())


def test_batch_table_replays_and_crashes(spark, workdir):
    t = BatchTable(spark, workdir + "/t", ["date"])
    assert held(t) == []
    t.append(numbers(spark, 1, 2), 0)
    t.append(numbers(spark, 3, 4, 5), 1)
    t.append(numbers(spark, 3, 4), 1)                      # a replay replaces its batch
    t._write(numbers(spark, 100), "b000000000002-crashed")  # written but never committed: not seen
    assert held(t) == [1, 2, 3, 4] and held(t, upto=0) == [1, 2]
    assert held(t, where=lambda f: f == "date=2024-01-02") == [1, 4]
    t.append(numbers(spark), 2)                             # an empty batch counts too
    t.append(numbers(spark, 6), 3)
    again = BatchTable(spark, workdir + "/t", ["date"])     # another reader
    assert held(again) == [1, 2, 3, 4, 6] and [p["first"] for p in again.parts()] == [0, 1, 2, 3]


def test_batch_table_compacts_in_one_step(spark, workdir, monkeypatch):
    t = BatchTable(spark, workdir + "/t", ["date"])
    for i in range(5):
        t.append(numbers(spark, 2 * i, 2 * i + 1), i, {"max_us": 10 - i})
    commit = t._commit
    monkeypatch.setattr(t, "_commit", lambda change: (_ for _ in ()).throw(OSError("crash before the commit")))
    with pytest.raises(OSError):
        t.compact()
    monkeypatch.setattr(t, "_commit", commit)
    assert held(t) == list(range(10)) and len(t.parts()) == 5  # the crash changed nothing
    before = t.versions()[-1]
    assert t.compact(keep_last=1) == 4 and held(t) == list(range(10))
    assert [(p["first"], p["last"]) for p in t.parts()] == [(0, 3), (4, 4)] and t.parts()[0]["stats"] == {"max_us": 10}
    assert len(t.parts(before)) == 5                        # a reader of the list before still finds its parts
    t.append(numbers(spark, 77), 2)                          # of a compacted batch: complete already
    t.append(numbers(spark, 8, 9, 10), 4)                    # the newest may be replayed
    assert held(t) == list(range(11))
    t.expire(lambda folder: folder <= "date=2024-01-01")
    assert held(t) == [v for v in range(11) if v % 3]
    assert t.vacuum(keep_versions=1) > 0 and held(t) == [v for v in range(11) if v % 3] and len(t.versions()) == 1


def test_two_writers_lose_no_part(spark, workdir):
    a, b = (BatchTable(spark, workdir + "/t", ["date"]) for _ in range(2))
    a.append(numbers(spark, 1), 0)
    stale = b.versions
    seen = [b.versions()]
    b.versions = lambda: seen.pop() if seen else stale()     # b commits on a list that a has followed meanwhile
    a.append(numbers(spark, 2), 1)
    b.append(numbers(spark, 3), 2)
    assert held(a) == [1, 2, 3]


def feed(spark):
    """A third of the payments of one sender, most of them inside one hour, equal times, null amounts."""
    hot = F.col("event_id") % 3 == 0
    at = F.expr("timestamp_ntz'2024-01-10 00:00:00' + make_dt_interval(0, 0, 0, (event_id div 4) * 2.5)")
    return (fx.transaction_source(spark, SF_SMALL)
            .withColumns({"sender_id": F.when(hot, "HOT").otherwise(F.concat(F.lit("S"), F.col("event_id") % 5)), "event_time": at,
                          "amount": F.when(F.col("event_id") % 11 == 0, F.lit(None)).otherwise(F.col("amount"))}))


@pytest.mark.parametrize("cfg,unit", [(ScoringConfig(), "1 second"), (ScoringConfig(), "30 seconds"), (CFG, "1 hour")])
def test_summaries_equal_the_batch_window(spark, workdir, cfg, unit):
    t = feed(spark).select("event_id", "txn_id", "sender_id", "amount", "event_time").persist()
    sums = SecondSums(spark, workdir, cfg, unit=unit, compact_every=2)
    cuts = [0, 200, 210, 700, 1000]
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        sums.add(t.filter((F.col("event_id") >= a) & (F.col("event_id") < b)), i).write.parquet(f"{workdir}/out/{i}")
        sums.tidy(i)
    got = spark.read.parquet(*[f"{workdir}/out/{i}" for i in range(4)])
    assert rounded(_velocity_out(got)) == rounded(_velocity_out(trailing_velocity(t, cfg)))
    assert got.filter("late").count() == 0


def test_hot_sender_is_dealt_over_its_seconds(spark, workdir):
    """What a batch adds to the state follows the batch, whatever is held; a group of the sort holds one second."""
    t = feed(spark).select("event_id", "txn_id", "sender_id", "amount", "event_time")
    sums = SecondSums(spark, workdir, ScoringConfig())
    for i in range(4):
        sums.add(t.filter(F.col("event_id").between(250 * i, 250 * i + 249)), i).count()
    per_batch = [spark.read.parquet(*[f"{sums.rows.data}/{f}/part={p['name']}" for f in p["folders"]]).count() for p in sums.rows.parts()]
    assert per_batch == [250] * 4
    seconds = sums.seconds.read(StructType.fromDDL("key string, sec long, n long"))
    assert seconds.filter("key = 'HOT'").agg(F.max("n")).first()[0] <= 2 and seconds.filter("key = 'HOT'").count() > 150
    plan = plan_of(sums.add(t.filter("event_id < 100"), 4))
    assert "hashpartitioning(key" in plan and "Python" not in plan and "Pandas" not in plan


def test_replay_late_rows_and_eviction(spark, workdir):
    zero = dt.datetime(2024, 1, 1)
    rows = lambda *secs: spark.createDataFrame([(f"t{s}", "A", 10.0, zero + dt.timedelta(seconds=s)) for s in secs],
                                               "txn_id string, sender_id string, amount double, event_time timestamp_ntz")
    sums = SecondSums(spark, workdir, ScoringConfig(allowed_lateness="1 minute"))
    assert [r.late for r in sums.add(rows(0, 30, 59), 0).collect()] == [False] * 3
    first = sorted(sums.add(rows(60, 61), 1).collect())
    assert sorted(sums.add(rows(60, 61), 1).collect()) == first  # a replay gives the same rows and adds nothing
    assert [(r.txn_id, r.txn_count_1m, r.txn_count_10m) for r in first] == [("t60", 4, 4), ("t61", 4, 5)]
    late = {r.txn_id: r for r in sums.add(rows(10, 62), 2).collect()}
    assert late["t10"].late and not late["t62"].late and late["t10"].txn_count_1m == 2 and late["t62"].txn_count_1m == 6
    sums.add(rows(5000), 3).count()
    sums.tidy(3)
    assert sums.rows.read(ROWS).count() == 1                      # all others lie beyond every window
    assert [r.txn_count_10m for r in sums.add(rows(5001, 5001), 4).collect()] == [3, 3]
    nobody = rows(5002).withColumn("sender_id", F.lit(None).cast("string"))
    assert [r.txn_count_1m for r in sums.add(nobody, 5).collect()] == [None]


def test_redeliveries_are_told_by_the_id_alone(spark, workdir):
    schema = "txn_id string, sender_id string, n int"
    batches = [[("a", "s", 1), ("b", "s", 2), (None, "s", 3), (None, "s", 3)], [("a", "other", 4), ("c", "s", 5), (None, "s", 3)], [("b", None, 6), ("d", "s", 7)]]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(workdir + "/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(workdir + "/in")
    q = (first_deliveries(stream, CFG).writeStream.format("parquet").option("path", workdir + "/out")
         .option("checkpointLocation", workdir + "/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    assert q.exception() is None
    assert sorted((r.n, r.txn_id) for r in spark.read.parquet(workdir + "/out").collect() if r.txn_id) == [(1, "a"), (2, "b"), (5, "c"), (7, "d")]
    assert spark.read.parquet(workdir + "/out").filter("txn_id is null").count() == 3


def test_bucketed_tables_stay_where_they_lie(spark, workdir):
    """Joins with a baseline or device table above the broadcast bound shuffle the payments alone."""
    from txnguard.operators.enrich import enrich_with_baseline, enrich_with_device
    from txnguard.sources.reference import open_bucketed, write_bucketed
    big = CFG.with_(broadcast_max_rows=0)
    t, base, dev = fx.transactions(spark, SF_SMALL), fx.baseline(spark, SF_SMALL, SPEC), fx.known_devices(spark, SF_SMALL, SPEC)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = [write_bucketed(base, f"{workdir}/b", "b_test", ["user_id"], 8),
                  write_bucketed(dev, f"{workdir}/d", "d_test", ["user_id", "device_id"], 8)]
        spark.sql("DROP TABLE d_test")  # the files stay; another session opens them
        tables[1] = open_bucketed(spark, f"{workdir}/d", "d_again", dev.schema, ["user_id", "device_id"], 8)
        joined = [enrich_with_baseline(t, tables[0], big), enrich_with_device(t, tables[1], big)]
        plain = [enrich_with_baseline(t, base, big), enrich_with_device(t, dev, big)]
        for a, b in zip(joined, plain):
            plan = plan_of(a)
            assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
            assert rounded(a, "txn_id", a.columns[-1]) == rounded(b, "txn_id", b.columns[-1])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("b_test", "d_again"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
