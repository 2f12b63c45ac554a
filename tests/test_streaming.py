"""Streaming: batch = stream, restart without loss or duplicates, idempotent
replays, late rows scored and counted."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from txnguard.config import FixtureSpec
from txnguard.plans.catalog import refs
from txnguard.plans.scoring import alerts, score
from txnguard.sources import fixtures as fx
from txnguard.sources.wire import parse_transactions, wire_rows
from txnguard.streaming import runner
from txnguard.streaming.job import JobPaths, ReferenceCache, make_batch_writer, start_scoring_job

SPEC = FixtureSpec()
CFG = SPEC.scoring()


def _run(spark, wire_dir, paths, files_per_trigger=1):
    q = start_scoring_job(spark, runner.read_wire_stream(spark, wire_dir, files_per_trigger), lambda: refs(spark, SF_SMALL),
                          paths, CFG, available_now=True)
    q.awaitTermination()
    assert q.exception() is None


def test_restart_resumes_without_loss_or_duplicates(spark, workdir):
    wire = wire_rows(fx.transaction_source(spark, SF_SMALL), SPEC, duplicates=True)
    wdir, paths = f"{workdir}/wire", JobPaths(f"{workdir}/job")
    k = runner.write_wire_files(wire, wdir, 4, only=[0, 1, 2], files_per_slice=2)
    _run(spark, wdir, paths, k)
    first = spark.read.parquet(paths.alerts).count()
    runner.write_wire_files(wire, wdir, 4, only=[3], files_per_slice=2)
    _run(spark, wdir, paths, k)  # same checkpoint: continues after the processed files
    got = spark.read.parquet(paths.alerts)
    batch = alerts(score(fx.transaction_source(spark, SF_SMALL), refs(spark, SF_SMALL), CFG), CFG)
    assert got.count() == got.select("txn_id").distinct().count()  # no doubled alert
    assert sorted(r[0] for r in got.select("txn_id").collect()) == sorted(r[0] for r in batch.select("txn_id").collect())
    assert 0 < first < got.count()


def test_replayed_batch_overwrites(spark, workdir):
    from txnguard.operators.velocity import trailing_velocity
    src = fx.transaction_source(spark, SF_SMALL)
    batch = (trailing_velocity(fx.transactions(spark, SF_SMALL), CFG)
             .withColumn("kafka_ts", F.col("event_time").cast("timestamp"))
             .withColumn("reject_reason", F.lit(None).cast("string"))
             .withColumn("raw_value", F.lit("{}")))
    assert src.count() == batch.count()
    paths = JobPaths(f"{workdir}/job")
    writer = make_batch_writer(paths, ReferenceCache(lambda: refs(spark, SF_SMALL), CFG), CFG)
    writer(batch, 7)
    writer(batch, 7)  # at-least-once replay of the same batch
    assert spark.read.parquet(paths.alerts).count() == 90


def test_no_payment_disappears(spark, workdir):
    """1 000 payments, every 50th delivered after all others, faulty and redelivered rows among them: each
    distinct delivered payment is in exactly one sink, and late rows are counted over all batches."""
    src = fx.transaction_source(spark, SF_SMALL)
    late = F.substring("txn_id", 5, 9).cast("long") % SPEC.late_mod == 0
    wdir, paths = f"{workdir}/wire", JobPaths(f"{workdir}/job")
    runner.write_wire_files(wire_rows(src, SPEC, duplicates=True), wdir, 3, last=late)
    _run(spark, wdir, paths)
    sinks = [spark.read.parquet(p).select("txn_id") for p in (paths.alerts, paths.safe)]
    got = sinks[0].unionByName(sinks[1])
    assert got.count() == got.distinct().count() == src.count()
    assert spark.read.parquet(paths.rejects).count() == 0
    n_late = spark.read.parquet(paths.stats).agg(F.sum("n_late")).first()[0]
    assert 0 < n_late <= src.filter(late).count()


def test_rejects_without_id_are_never_merged(spark, workdir):
    from pyspark.sql.types import BinaryType, StructField, StructType, TimestampType
    import datetime as dt
    at = dt.datetime(2024, 1, 5)
    rows = [(None, at)] * 3 + [(b"garbage", at)] * 2
    schema = StructType([StructField("value", BinaryType()), StructField("timestamp", TimestampType())])
    wdir, paths = f"{workdir}/wire", JobPaths(f"{workdir}/job")
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(wdir)
    _run(spark, wdir, paths)
    assert spark.read.parquet(paths.rejects).count() == 5


def test_stream_trailing_velocity_equals_batch(spark):
    from txnguard.plans.catalog import q12_trailing_velocity, q15_stream_trailing_velocity
    s = {r["txn_id"]: r for r in q15_stream_trailing_velocity(spark, SF_SMALL).collect()}
    b = {r["txn_id"]: r for r in q12_trailing_velocity(spark, SF_SMALL).collect()}
    assert s.keys() == b.keys()
    diff = [k for k in b if tuple(s[k]) != tuple(b[k])]
    assert not diff, diff[:5]


def test_parallel_slices_keep_stream_equal_to_batch(spark, workdir):
    """Slices written by several tasks (3 files each, one trigger per slice) give
    the same per-row velocity as the batch window."""
    from txnguard.config import ScoringConfig
    from txnguard.plans.catalog import _velocity_out, q12_trailing_velocity
    from txnguard.streaming.velocity_state import trailing_velocity_stream
    wdir = f"{workdir}/wire"
    k = runner.write_wire_files(wire_rows(fx.transaction_source(spark, SF_SMALL), SPEC), wdir, 4,
                                files_per_slice=3)
    assert k == 3 and len(spark.read.parquet(wdir).inputFiles()) == 12
    stream = parse_transactions(runner.read_wire_stream(spark, wdir, k), watermark=ScoringConfig().watermark)
    vel = trailing_velocity_stream(stream, CFG)
    q = (vel.writeStream.format("parquet").option("path", f"{workdir}/out")
         .option("checkpointLocation", f"{workdir}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 4  # one trigger per slice
    s = {r["txn_id"]: r for r in _velocity_out(spark.read.parquet(f"{workdir}/out")).collect()}
    b = {r["txn_id"]: r for r in q12_trailing_velocity(spark, SF_SMALL).collect()}
    assert s.keys() == b.keys()
    assert not [t for t in b if tuple(s[t]) != tuple(b[t])]


def test_short_slice_padded_to_full_trigger(spark, workdir):
    src = fx.transaction_source(spark, SF_SMALL).limit(2)   # fewer rows than files per slice
    wdir = f"{workdir}/wire"
    k = runner.write_wire_files(wire_rows(src, SPEC), wdir, 1, files_per_slice=5)
    assert len(spark.read.parquet(wdir).inputFiles()) == k == 5
    assert spark.read.parquet(wdir).count() == 2


def test_parse_repartition_keeps_rows(spark):
    raw = wire_rows(fx.transaction_source(spark, SF_SMALL), SPEC)
    a = parse_transactions(raw)
    b = parse_transactions(raw, repartition=4)
    assert b.rdd.getNumPartitions() == 4
    assert sorted(a.select("txn_id").collect()) == sorted(b.select("txn_id").collect())


def test_console_sink_runs(spark, workdir, capsys):
    wire = wire_rows(fx.transaction_source(spark, SF_SMALL), SPEC)
    wdir, paths = f"{workdir}/wire", JobPaths(f"{workdir}/job")
    runner.write_wire_files(wire, wdir, 1)
    q = start_scoring_job(spark, runner.read_wire_stream(spark, wdir), lambda: refs(spark, SF_SMALL), paths, CFG,
                          available_now=True, console=True)
    q.awaitTermination()
    assert q.exception() is None
    assert "final_fraud_score" in capsys.readouterr().out


def test_rocksdb_state_store_parity(spark):
    """The provider ``build_session`` configures gives the same per-row velocity."""
    from txnguard.plans.catalog import q12_trailing_velocity, q15_stream_trailing_velocity
    from txnguard.session import ROCKSDB_PROVIDER
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(key, ROCKSDB_PROVIDER)
    try:
        s = sorted(q15_stream_trailing_velocity(spark, SF_SMALL).collect())
    finally:
        spark.conf.unset(key)
    assert s == sorted(q12_trailing_velocity(spark, SF_SMALL).collect())
