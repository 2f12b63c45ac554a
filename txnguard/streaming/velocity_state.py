"""Per-row trailing velocity and redelivery dedup in Structured Streaming (stateful, no row is lost).

State is keyed by (hash slot of the sender, time bucket modulo ``RING``). A group keeps (sender, epoch micros,
amount, transaction id) of the rows it has seen; each new row's window [t - d, t] is evaluated over state +
batch with sorted-array searches on a composite (sender, time) key (numpy on the Arrow batch). Rows near a
bucket's end are copied into the next bucket, so every window lies inside one group.

Late rows: the state function runs without an event-time timeout, so rows behind the watermark are not
filtered out; they are scored on the rows still held and marked in ``late``. Rows are held until they are older
than watermark - (long window + ``cfg.allowed_lateness``), so a row that is late by at most that has its full
window. Buckets reuse a ring of groups, which evicts old rows without timers and bounds the number of groups.

Dedup: a row whose transaction id is held by its group already is a redelivery (same sender and event time, so
same group) and is dropped; rows without an id are never dropped. Rows without a sender (rejects) are spread
over the slots by a hash of their payload, deduplicated by id where they have one, and get no velocity.

Limits: the rows of one slot and bucket form one Python group per batch, and its state is rewritten whole when
it changes. The live rows of a hot sender all lie in the current bucket, so the group of its slot grows with
its rate; only its history is spread over buckets.

Ties: a row arriving in a later micro-batch with the same or earlier event time as an already-emitted row
cannot change that row's result (it was emitted already).
"""

from __future__ import annotations

import warnings

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.types import (
    ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
)

from txnguard.config import ScoringConfig
from txnguard.functions.frames import frame_stats

# pandas concat inside the Arrow serializer warns on all-null columns; harmless here
warnings.filterwarnings("ignore", category=FutureWarning)

#: Buckets that share the groups of a slot; three would do (a bucket, the next, and one between reuses).
RING = 4

STATE_SCHEMA = StructType([
    StructField("snd", ArrayType(StringType())),
    StructField("ts", ArrayType(LongType())),
    StructField("amt", ArrayType(DoubleType())),
    StructField("ids", ArrayType(StringType())),
])

VELOCITY_FIELDS = [
    StructField("txn_count_1m", IntegerType()),
    StructField("total_amount_1m", DoubleType()),
    StructField("txn_count_10m", IntegerType()),
    StructField("total_amount_10m", DoubleType()),
    StructField("avg_amount_10m", DoubleType()),
    StructField("stddev_amount_10m", DoubleType()),
]


def window_stats(snd, ts, amt, q_snd, q_ts, span: int):
    """count, sum, avg, stddev of each query's window; null amounts count as rows but not in the sums."""
    known = ~np.isnan(amt)
    n, total, avg, std = frame_stats(snd, ts, np.where(known, amt, 0.0), q_snd, q_ts, span)
    if not known.all():
        m, total, avg, std = frame_stats(snd[known], ts[known], amt[known], q_snd, q_ts, span)
        total, avg = np.where(m > 0, total, np.nan), np.where(m > 0, avg, np.nan)
    return n, total, avg, std


def make_velocity_fn(cfg: ScoringConfig, key: str, out_cols: list[str], dedup_key: str | None):
    d1, d2, hold = cfg.short_micros, cfg.long_micros, cfg.long_micros + cfg.lateness_micros

    def fn(group_key, batches, state):
        parts = [b for b in batches if len(b)]
        if not parts:
            return
        pdf = pd.concat(parts, ignore_index=True)
        old_snd, old_ts, old_amt, old_ids = state.get if state.exists else ([], [], [], [])
        if dedup_key is not None:
            pdf = pdf.sort_values("kafka_ts", kind="stable") if "kafka_ts" in pdf else pdf
            ids = pdf[dedup_key]
            pdf = pdf[ids.isna() | ~(ids.isin([i for i in old_ids if i is not None]) | ids.duplicated())]
        if not len(pdf):
            return
        wm_us = state.getCurrentWatermarkMs() * 1000
        has_key = pdf[key].notna().to_numpy()
        us = pdf["_v_us"].to_numpy(dtype=np.float64)
        rejects = pdf[~has_key & (pdf["_v_copy"] == 0).to_numpy()]
        if len(rejects):
            yield rejects.assign(late=(us < wm_us)[~has_key & (pdf["_v_copy"] == 0).to_numpy()],
                                 **{f.name: None for f in VELOCITY_FIELDS})[out_cols]
        new_ids = pdf[dedup_key].to_numpy(dtype=object) if dedup_key else np.full(len(pdf), None, object)
        all_snd = np.concatenate([np.asarray(old_snd, dtype=object), pdf[key].to_numpy(dtype=object)])
        all_ts = np.concatenate([np.asarray(old_ts, dtype=np.int64), np.nan_to_num(us, nan=0).astype(np.int64)])
        all_amt = np.concatenate([np.asarray(old_amt, dtype=np.float64), pdf["amount"].to_numpy(dtype=np.float64)])
        all_ids = np.concatenate([np.asarray(old_ids, dtype=object), new_ids])
        owners = pdf[has_key & (pdf["_v_copy"] == 0).to_numpy()]
        if len(owners):
            with_sender = np.array([s is not None and s == s for s in all_snd], bool)
            snd, ts, amt = all_snd[with_sender], all_ts[with_sender], all_amt[with_sender]
            q_snd = owners[key].to_numpy(dtype=object)
            q_ts = owners["_v_us"].to_numpy(dtype=np.int64)
            c1, s1, _, _ = window_stats(snd, ts, amt, q_snd, q_ts, d1)
            c2, s2, a2, sd2 = window_stats(snd, ts, amt, q_snd, q_ts, d2)
            yield owners.assign(late=q_ts < wm_us, txn_count_1m=c1.astype(np.int32), total_amount_1m=s1,
                                txn_count_10m=c2.astype(np.int32), total_amount_10m=s2,
                                avg_amount_10m=a2, stddev_amount_10m=sd2)[out_cols]
        keep = (all_ts >= wm_us - hold) & np.array([s is not None and s == s or i is not None
                                                    for s, i in zip(all_snd, all_ids, strict=True)], bool)
        state.update(([s if s == s else None for s in all_snd[keep]], all_ts[keep].tolist(), all_amt[keep].tolist(),
                      [i if i == i else None for i in all_ids[keep]]))

    return fn


def trailing_velocity_stream(stream: DataFrame, cfg: ScoringConfig = ScoringConfig(),
                             key: str = "sender_id", ts: str = "event_time",
                             slots: int | None = None, dedup_key: str | None = None) -> DataFrame:
    """Streaming twin of ``operators.velocity.trailing_velocity``. ``stream`` must
    carry a watermark on ``ts`` (TIMESTAMP). Output: input columns, ``late`` (behind the watermark when it
    arrived) and 6 velocity columns, append mode; with ``dedup_key``, redeliveries are left out.

    ``slots`` defaults to 4 x spark.sql.shuffle.partitions and, like the partition count, must stay the
    same for the life of a checkpoint.
    """
    width, d2 = cfg.bucket_micros, cfg.long_micros
    if slots is None:
        slots = 4 * int(stream.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    us = F.unix_micros(F.col(ts))
    bucket = F.expr(f"(_v_us - pmod(_v_us, {width})) div {width}")
    in_tail = F.col(key).isNotNull() & (F.col("_v_us") >= (bucket + 1) * F.lit(width) - F.lit(d2))
    payload = [F.col(c).cast("string") for c in (dedup_key, "raw_value", "kafka_ts") if c in stream.columns]
    slot = F.pmod(F.when(F.col(key).isNotNull(), F.xxhash64(key)).otherwise(F.xxhash64(*(payload or [F.lit(0)]))),
                  F.lit(slots))
    staged = (stream.withColumn("_v_us", us)
              .withColumn("_v_copy", F.explode(F.when(in_tail, F.array(F.lit(0), F.lit(1)))
                                               .otherwise(F.array(F.lit(0)))))
              .withColumn("_v_bucket", bucket + F.col("_v_copy"))
              .withColumn("_v_ring", F.when(F.col(key).isNull(), F.lit(-1))
                          .otherwise(F.pmod(F.col("_v_bucket"), F.lit(RING)).cast("int")))
              .withColumn("_v_slot", slot))
    out_schema = StructType([*stream.schema.fields, StructField("late", BooleanType()), *VELOCITY_FIELDS])
    out_cols = [f.name for f in out_schema.fields]
    fn = make_velocity_fn(cfg, key, out_cols, dedup_key)
    return (staged.groupBy("_v_slot", "_v_ring")
            .applyInPandasWithState(fn, out_schema, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout))
