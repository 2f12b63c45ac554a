"""Geo-velocity: distance, time gap and speed from the sender's previous
transaction (haversine in native column functions, no Python UDF).

A plain ``lag`` over ``partitionBy(sender)`` puts a hot sender's whole history in
one task. Here rows are partitioned by (sender, time bucket); ``lag`` runs inside
each bucket and the first row of a bucket takes the last row of the sender's
previous non-empty bucket from a per-bucket summary (one row per sender and
bucket), joined back on the same (sender, bucket) keys, so the large side keeps
its partitioning. Any bucket width gives the same result; ``bucket="auto"`` sizes
it from the densest sender-day (one aggregate, one number to the driver) so that a
bucket holds at most about ``target_rows`` rows of one sender (1 minute to 1 day).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from txnguard.config import duration_micros
from txnguard.functions.expressions import epoch_micros, haversine_km


DAY_MICROS = duration_micros("1 day")
MINUTE_MICROS = duration_micros("1 minute")


def bucket_width(df: DataFrame, key: str = "sender_id", ts: str = "event_time",
                 target_rows: int = 1_000_000) -> int:
    """Bucket width (micros) for the densest sender: a day, narrowed in proportion
    when some sender has more than ``target_rows`` rows in one day."""
    ntz = isinstance(df.schema[ts].dataType, TimestampNTZType)
    day = F.floor(epoch_micros(ts, ntz=ntz) / F.lit(DAY_MICROS))
    densest = (df.groupBy(F.col(key), day.alias("_g_day")).agg(F.count(F.lit(1)).alias("n"))
               .agg(F.max("n")).first()[0] or 0)
    if densest <= target_rows:
        return DAY_MICROS
    return max(MINUTE_MICROS, DAY_MICROS * target_rows // densest)


def previous_point(df: DataFrame, key: str = "sender_id", ts: str = "event_time",
                   tie: str = "txn_id", cols: tuple[str, ...] = ("lat", "lon"),
                   bucket: str = "auto", target_rows: int = 1_000_000) -> DataFrame:
    """+ prev_us (epoch micros of the previous row) and prev_<col> for ``cols``.
    ``bucket``: a duration ("1 day") or "auto" (``bucket_width``)."""
    width = bucket_width(df, key, ts, target_rows) if bucket == "auto" else duration_micros(bucket)
    ntz = isinstance(df.schema[ts].dataType, TimestampNTZType)
    staged = (df.withColumn("_g_us", epoch_micros(ts, ntz=ntz))
              .withColumn("_g_b", F.expr(f"(_g_us - pmod(_g_us, {width})) div {width}")))
    w = Window.partitionBy(key, "_g_b").orderBy("_g_us", tie)
    inner = staged.withColumns({
        "_g_prev_us": F.lag("_g_us").over(w),
        **{f"_g_prev_{c}": F.lag(c).over(w) for c in cols},
    })
    last = (staged.groupBy(key, "_g_b")
            .agg(F.max_by(F.struct("_g_us", *cols), F.struct("_g_us", tie)).alias("_g_last")))
    wb = Window.partitionBy(key).orderBy("_g_b")
    bridge = last.select(F.col(key).alias("_g_key"), F.col("_g_b").alias("_g_bb"),
                         F.lag("_g_last").over(wb).alias("_g_before"))
    joined = inner.join(bridge, (inner[key] == bridge["_g_key"]) & (inner["_g_b"] == bridge["_g_bb"]), "left")
    first = F.col("_g_prev_us").isNull()
    return (joined.withColumns({
        "prev_us": F.when(first, F.col("_g_before._g_us")).otherwise(F.col("_g_prev_us")),
        **{f"prev_{c}": F.when(first, F.col(f"_g_before.{c}")).otherwise(F.col(f"_g_prev_{c}")) for c in cols},
    }).withColumn("_g_us_out", F.col("_g_us"))
      .drop("_g_key", "_g_bb", "_g_before", "_g_b", "_g_prev_us", *[f"_g_prev_{c}" for c in cols]))


def geo_velocity(df: DataFrame, key: str = "sender_id", ts: str = "event_time",
                 bucket: str = "auto", target_rows: int = 1_000_000) -> DataFrame:
    """+ distance_km, gap_seconds, speed_kmh (null without a previous point or for a
    zero time gap)."""
    p = previous_point(df, key, ts, bucket=bucket, target_rows=target_rows)
    gap = (F.col("_g_us_out") - F.col("prev_us")).cast("double") / F.lit(1e6)
    dist = haversine_km("prev_lat", "prev_lon", "lat", "lon")
    return (p.withColumns({"distance_km": dist, "gap_seconds": gap})
            .withColumn("speed_kmh", F.when(F.col("gap_seconds") > 0,
                                            F.col("distance_km") / (F.col("gap_seconds") / F.lit(3600.0))))
            .drop("_g_us", "_g_us_out", "prev_us", "prev_lat", "prev_lon"))
