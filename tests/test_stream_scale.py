"""The stream's input and state are dealt to all cores, whatever the number of files and of shuffle partitions."""

import glob

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from txnguard.config import ScoringConfig
from txnguard.sources import fixtures as fx
from txnguard.streaming import runner
from txnguard.streaming.second_sums import SecondSums


def test_a_slice_has_a_file_a_core(spark, workdir):
    n, cores = 4 * runner.TASK_ROWS * 2, spark.sparkContext.defaultParallelism
    wire = spark.range(n).select(F.encode(F.concat(F.lit("no json "), F.col("id").cast("string")), "UTF-8").alias("value"),
                                 F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id")).alias("timestamp"))
    k = runner.write_wire_files(wire, f"{workdir}/wire", 4)
    got = spark.read.parquet(f"{workdir}/wire")
    assert k == min(2, cores) and len(got.inputFiles()) == 4 * k
    assert got.count() == got.distinct().count() == n and wire.exceptAll(got).isEmpty()
    sizes = [r["count"] for r in got.groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) < 2 * min(sizes)


def test_payments_are_made_on_all_cores(spark):
    plan = fx.transaction_source(spark, SF_SMALL, spread=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [event_id" in plan and plan.index("get_json_object") < plan.index("RepartitionByExpression")


def test_state_files_do_not_follow_the_shuffle_partitions(spark, workdir):
    cores = spark.sparkContext.defaultParallelism
    rows = [(f"s{i % 7}", i * 100_000) for i in range(2_000)]
    batch = (spark.createDataFrame(rows, "sender_id string, us long").withColumn("amount", F.lit(1.0))
             .withColumn("event_time", F.timestamp_micros("us")).repartition(8 * cores, "us"))
    sums = SecondSums(spark, f"{workdir}/state", ScoringConfig())
    got = sums.add(batch, 0)
    assert got.count() == 2_000 and got.filter("txn_count_1m is null").isEmpty()
    files = glob.glob(f"{workdir}/state/rows/data/*/*/*.parquet")
    assert 0 < len(files) <= cores * len(sums.rows.parts()[0]["folders"])
