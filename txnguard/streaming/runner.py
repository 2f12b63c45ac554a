"""Helpers to run a streaming plan to completion (tests and registered queries)
and to lay down a file-source fixture that replays wire rows in event order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from txnguard.sources.wire import read_transactions


#: Rows of a slice for which another task is worth its start.
TASK_ROWS = 5_000


def write_wire_files(wire: DataFrame, path: str, n_files: int, only: range | list | None = None,
                     files_per_slice: int | None = None, rows_per_file: int = 1_000_000,
                     last: Column | None = None) -> int:
    """Lay down wire rows as ``n_files`` event-time slices, for a file-source replay
    with one slice per trigger. Returns the files per slice: read the folder back
    with ``read_wire_stream(..., files_per_trigger=<that>)``.

    The order key is the stream's own event time (parsed ``event_time``, or the
    delivery time when the payload does not parse), split into equal time ranges
    from its min/max (two scalars to the driver). Slices are written one after the
    other, because the file source orders files by modification time; a later
    slice then never holds events older than an earlier slice's watermark.

    Each slice is written by ``files_per_slice`` parallel tasks (default: from the staging row count, a file a core
    as long as it holds ``TASK_ROWS`` rows, and enough that a file holds at most ``rows_per_file``; the stream reads
    a file in one task, so its parallelism is that of the files). A slice that came out with fewer
    files (empty partitions) is padded with empty files, so every
    trigger of ``files_per_slice`` files holds exactly one slice.

    ``last``: a condition on the payload's fields; rows that meet it are held back and delivered as one more
    slice after all others, so they are late.
    """
    from pyspark.sql import functions as F

    from txnguard.sources.wire import PARSE_OPTIONS
    from txnguard.schemas import TRANSACTION_SCHEMA

    spark = wire.sparkSession
    parsed = F.from_json(F.col("value").cast("string"), TRANSACTION_SCHEMA, PARSE_OPTIONS)
    late = F.lit(False)
    if last is not None:
        wire = wire.select("*", parsed.alias("_p")).select("*", "_p.*")
        late = F.coalesce(last, F.lit(False))
    parsed_time = parsed["event_time"]
    staging = f"{path.rstrip('/')}_staging"
    # one parallel pass; sorted inside each task, so row-group min/max let a slice skip most row groups
    (wire.select("value", "timestamp", F.unix_micros(F.coalesce(parsed_time, F.col("timestamp"))).alias("_order"),
                 late.alias("_late"))
         .sortWithinPartitions("_order")
         .write.mode("overwrite").parquet(staging))
    keyed = spark.read.parquet(staging)
    rows, lo, hi = keyed.agg(F.count(F.lit(1)), F.min("_order"), F.max("_order")).first()
    k = files_per_slice or max(1, -(-rows // (n_files * rows_per_file)),
                               min(spark.sparkContext.defaultParallelism, rows // (n_files * TASK_ROWS)))
    step = max(1, -(-(hi - lo + 1) // n_files))
    for i in (only if only is not None else range(n_files + (last is not None))):
        lo_i, hi_i = lo + i * step, lo + (i + 1) * step
        wanted = F.col("_late") if i == n_files else ~F.col("_late") & (F.col("_order") >= lo_i) & (F.col("_order") < hi_i)
        part = keyed.filter(wanted).select("value", "timestamp")
        before = _n_files(spark, path)
        (part.coalesce(1) if k == 1 else part.repartition(k, "value", "timestamp")).write.mode("append").parquet(path)
        for _ in range(k - (_n_files(spark, path) - before)):
            part.limit(0).write.mode("append").parquet(path)   # one empty file each
    return k


def _n_files(spark: SparkSession, path: str) -> int:
    """Data files under ``path``, counted by the file system's own listing (no data is read)."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return sum(f.getPath().getName().endswith(".parquet") for f in fs.listStatus(folder)) if fs.exists(folder) else 0


def read_wire_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    return read_transactions(spark, "parquet", path, {"maxFilesPerTrigger": files_per_trigger})


def run_to_parquet(df: DataFrame, path: str, checkpoint: str, mode: str = "append",
                   name: str | None = None) -> None:
    """Process everything available, then stop (``availableNow``)."""
    w = (df.writeStream.format("parquet").outputMode(mode)
         .option("path", path).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True))
    if name:
        w = w.queryName(name)
    q = w.start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()
