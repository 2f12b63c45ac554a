"""Reference tables: builders (from transaction history) and snapshot readers.

Baseline (A3) and known devices (A5) are aggregates over history, so they run as
partial + final hash aggregates (map-side combine handles a hot sender). Snapshots
are written partitioned by ``snapshot_date`` so that reads prune to one folder. A baseline can also be kept
as moments, which a day's payments are merged into (``refresh_baseline``), so a refresh doesn't read the history again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def build_baseline(history: DataFrame, key: str = "sender_id") -> DataFrame:
    """user_id, avg_amount, stddev_amount (sample; null for one row), n_txn."""
    return (history.groupBy(F.col(key).alias("user_id"))
            .agg(F.avg("amount").alias("avg_amount"),
                 F.stddev_samp("amount").alias("stddev_amount"),
                 F.count(F.lit(1)).alias("n_txn")))


def amount_moments(rows: DataFrame, key: str = "sender_id") -> DataFrame:
    """Mergeable form of a baseline: user_id, n_txn, n (known amounts), total, m2 (their squared deviations)."""
    n = F.count("amount")
    return (rows.groupBy(F.col(key).alias("user_id"))
            .agg(F.count(F.lit(1)).alias("n_txn"), n.alias("n"), F.sum("amount").alias("total"),
                 (F.var_pop("amount") * n).alias("m2")))


def merge_moments(parts: DataFrame) -> DataFrame:
    """One row a user from moments of disjoint rows. The squared deviations of the whole are those of the parts and of the
    parts' means from the common one, so nothing is lost to large means."""
    user = Window.partitionBy("user_id")
    mean = F.sum("total").over(user) / F.nullif(F.sum("n").over(user), F.lit(0))
    apart = F.col("total") / F.nullif(F.col("n"), F.lit(0)) - F.col("_mean")
    parts = parts.select("user_id", "n_txn", "n", "total", "m2", mean.alias("_mean"))
    return (parts.groupBy("user_id")
            .agg(F.sum("n_txn").alias("n_txn"), F.sum("n").alias("n"), F.sum("total").alias("total"),
                 F.sum(F.col("m2") + F.col("n") * apart * apart).alias("m2")))


def baseline_of_moments(moments: DataFrame) -> DataFrame:
    """The baseline (see :func:`build_baseline`) of merged moments."""
    return moments.select("user_id", (F.col("total") / F.nullif(F.col("n"), F.lit(0))).alias("avg_amount"),
                          F.when(F.col("n") > 1, F.sqrt(F.col("m2") / F.nullif(F.col("n") - 1, F.lit(0)))).alias("stddev_amount"), "n_txn")


def write_history(txn: DataFrame, path: str, ts: str = "event_time") -> None:
    """Payments under one folder a day, as the daily refresh reads them."""
    (txn.withColumn("event_date", F.to_date(ts).cast("string"))
     .write.mode("overwrite").partitionBy("event_date").parquet(path))


def new_day(spark: SparkSession, history: str, day: str) -> DataFrame:
    """The payments of one day; the filter becomes a PartitionFilter, so no other day is listed or read."""
    return spark.read.parquet(history).filter(F.col("event_date") == day)


def refresh_baseline(spark: SparkSession, history: str, snapshots: str, day: str, previous: str | None) -> None:
    """The moments of all days up to ``day``, as a dated snapshot: those of snapshot ``previous`` (None: none) merged with the
    moments of that one day. Reads one snapshot and one day however long the history is."""
    moments = amount_moments(new_day(spark, history, day))
    if previous is not None:
        moments = merge_moments(read_snapshot(spark, snapshots, previous).unionByName(moments))
    write_snapshot(moments, snapshots, day)


def build_known_devices(history: DataFrame) -> DataFrame:
    """Distinct (user_id, device_id) seen in history, with first sighting."""
    return (history.filter(F.col("device_id").isNotNull())
            .groupBy(F.col("sender_id").alias("user_id"), "device_id")
            .agg(F.min("event_time").alias("first_seen"),
                 F.count(F.lit(1)).alias("n_txn")))


def write_snapshot(df: DataFrame, path: str, snapshot_date: str, mode: str = "overwrite") -> None:
    """Write one dated snapshot; dynamic partition overwrite replaces only that date."""
    (df.withColumn("snapshot_date", F.lit(snapshot_date))
       .write.mode(mode)
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy("snapshot_date")
       .parquet(path))


def read_snapshot(spark: SparkSession, path: str, snapshot_date: str) -> DataFrame:
    """Read one snapshot; the date filter becomes a PartitionFilter (folder pruning)."""
    return (spark.read.parquet(path)
            .filter(F.col("snapshot_date") == snapshot_date)
            .drop("snapshot_date"))


def write_bucketed(df: DataFrame, path: str, table: str, keys: list[str], buckets: int) -> DataFrame:
    """A reference table too large to broadcast, dealt into ``buckets`` files by its join keys and sorted by them, under
    ``path``. Joins on exactly these keys then move only the other side. Returns the table."""
    (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))
    return df.sparkSession.table(table)


def open_bucketed(spark: SparkSession, path: str, table: str, schema: StructType, keys: list[str], buckets: int) -> DataFrame:
    """A table that another session wrote by :func:`write_bucketed` (the session's catalog may not outlive it)."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) "
              f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower: int | None = None,
              upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """JDBC reader for a database-held reference table (blacklist, device history).

    Give ``partition_column``/bounds for parallel range reads of large tables.
    Not exercised here: no database may be started in this environment.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", lower).option("upperBound", upper)
                  .option("numPartitions", num_partitions or 8))
    return reader.load()
