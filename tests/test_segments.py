"""Validity segments and their binned join: brute-force equal, and work that follows the list and not its overlaps."""

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from txnguard.config import FixtureSpec
from txnguard.operators.enrich import (
    SegmentDimension, enrich_with_blacklist, enrich_with_entity_blacklist_asof, segment_dimension, validity_segments,
)
from txnguard.sources import fixtures as fx

CFG = FixtureSpec().scoring()
START = pd.Timestamp("2024-01-01")


def listings(spark, rows):
    """(entity, severity, from second, to second or None)"""
    at = lambda s: None if s is None else (START + pd.Timedelta(seconds=int(s))).to_pydatetime()
    return spark.createDataFrame([(e, "DEVICE", v, at(a), at(b)) for e, v, a, b in rows],
                                 "entity_id string, entity_type string, severity int, listed_at timestamp_ntz, expires_at timestamp_ntz")


def swept(rows):
    """Segments of one entity by a sweep over its boundaries with a heap of the active listings."""
    rows = [r for r in rows if r[1] is not None and (r[3] is None or r[2] < r[3])]
    points = sorted({p for _, _, a, b in rows for p in (a, b) if p is not None})
    by_start, heap, out, i = sorted(rows, key=lambda r: r[2]), [], [], 0
    for k, p in enumerate(points):
        while i < len(by_start) and by_start[i][2] <= p:
            heapq.heappush(heap, (-by_start[i][1], float("inf") if by_start[i][3] is None else by_start[i][3]))
            i += 1
        while heap and heap[0][1] <= p:
            heapq.heappop(heap)
        if heap:
            out.append((p, points[k + 1] if k + 1 < len(points) else None, -heap[0][0]))
    return out


def seconds(df):
    got = df.select("entity_id", F.unix_timestamp(F.col("seg_start").cast("timestamp")).alias("a"),
                    F.unix_timestamp(F.col("seg_end").cast("timestamp")).alias("b"), "severity").collect()
    zero = int(START.timestamp())
    return sorted((r.entity_id, r.a - zero, -1 if r.b is None else r.b - zero, r.severity) for r in got)


def test_segments_equal_a_sweep(spark):
    rng = np.random.default_rng(4)
    rows = []
    for e in range(12):
        for _ in range(int(rng.integers(1, 60))):
            a = int(rng.integers(0, 400_000))
            kind = rng.integers(8)
            b = None if kind == 0 else a if kind == 1 else a - 5 if kind == 2 else a + int(rng.integers(1, 200_000))
            rows.append((f"d{e}", None if kind == 3 else int(rng.integers(-3, 900)), a, b))
    want = sorted((f"d{e}", a, -1 if b is None else b, v) for e in range(12) for a, b, v in swept([r for r in rows if r[0] == f"d{e}"]))
    assert seconds(validity_segments(listings(spark, rows + rows[:20]), "DEVICE")) == want


def test_one_entity_of_many_overlapping_listings(spark):
    """200,000 listings of one entity, most of them active together: about n log n rows, no listing meets the boundaries
    that it covers (that would be 1e10 rows)."""
    n = 200_000
    rng = np.random.default_rng(5)
    a = rng.integers(0, 10_000_000, n)
    b = a + rng.integers(1, 10_000_000, n)
    v = rng.integers(1, 100_000, n)
    pdf = pd.DataFrame({"entity_id": "hot", "entity_type": "DEVICE", "severity": v.astype("int32"),
                        "listed_at": START + pd.to_timedelta(a, unit="s"), "expires_at": START + pd.to_timedelta(b, unit="s")})
    bl = spark.createDataFrame(pdf).select("entity_id", "entity_type", "severity", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("listed_at", "expires_at")])
    assert seconds(validity_segments(bl, "DEVICE")) == [
        ("hot", x, -1 if y is None else y, s) for x, y, s in swept(list(zip(["hot"] * n, v.tolist(), a.tolist(), b.tolist())))]


def test_hot_receiver_of_many_segments_is_binned(spark):
    """Half of the payments go to one receiver with 10,000 segments: it is dealt over many bins, a payment meets the
    segments of one bin, and every row gets the severity of the listings valid at its time."""
    n = 10_000
    rows = [("HOT", 1 + i % 50, 100 * i, 100 * i + 60 + (i % 3) * 30) for i in range(n)] + [("HOT", 99, 100 * n, None), ("COLD", 3, 500, 900)]
    bl = listings(spark, rows).withColumn("entity_type", F.lit("USER"))
    txn = spark.range(4000).select(
        F.col("id").alias("txn_id"), F.when(F.col("id") % 2 == 0, "HOT").when(F.col("id") % 4 == 1, "COLD").otherwise("NONE").alias("receiver_id"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * 251)").alias("event_time"))
    dim = segment_dimension(bl, "USER", CFG)
    assert isinstance(dim, SegmentDimension) and dim.grid.count() == 1
    per_bin = dim.segments.groupBy("_key", "_bin").count()
    assert per_bin.filter("_key = 'HOT'").count() > 1000 and per_bin.agg(F.max("count")).first()[0] <= 40
    assert dim.segments.count() <= 2 * len(rows) + per_bin.count()
    got = {r.txn_id: r.bl_receiver_severity for r in enrich_with_blacklist(txn, None, CFG, dim=dim).collect()}
    hot = sorted((a, b if b is not None else 1e18, v) for e, v, a, b in rows if e == "HOT")
    want = {}
    for i in range(4000):
        t = i * 251
        if i % 2 == 0:
            k = min(t // 100, n)
            want[i] = max((v for a, b, v in hot[max(0, k - 2):k + 1] if a <= t < b), default=None)
        else:
            want[i] = 3 if i % 4 == 1 and 500 <= t < 900 else None
    assert got == want
    plan = enrich_with_blacklist(txn, None, CFG, dim=dim)._jdf.queryExecution().optimizedPlan().toString()
    assert "_s_at" in plan and "_s_bin" in plan


def test_bins_change_no_result(spark, monkeypatch):
    from txnguard.operators import enrich
    txn, bl = fx.transactions(spark, SF_SMALL), fx.blacklist_long(spark, SF_SMALL)
    plain = sorted(enrich_with_entity_blacklist_asof(txn, bl, CFG).select("txn_id", "bl_device_severity", "bl_ip_severity").collect())
    assert segment_dimension(bl, ["DEVICE", "IP"], CFG).grid is None
    monkeypatch.setattr(enrich.segment_dimension, "__defaults__", (CFG, True, 1))
    assert enrich.segment_dimension(bl, ["DEVICE", "IP"], CFG).grid is not None
    assert sorted(enrich_with_entity_blacklist_asof(txn, bl, CFG).select("txn_id", "bl_device_severity", "bl_ip_severity").collect()) == plain
