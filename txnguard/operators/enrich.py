"""Enrichment joins (all LEFT OUTER; one output row per transaction).

J1 blacklisted receiver, J2 baseline + z-score, J3 known device, J4 DEVICE/IP
blacklist by key and by validity interval; plus calendar features.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from txnguard.config import ScoringConfig
from txnguard.functions.expressions import calendar_columns, epoch_micros, instant_to_utc_ntz, zscore
from txnguard.operators.dims import materialize as written
from txnguard.operators.dims import sized_dimension


def max_severity(blacklist: DataFrame, entity_type: str) -> DataFrame:
    """One row per entity: duplicates in the list must not fan transactions out."""
    return (blacklist.filter(F.col("entity_type") == entity_type)
            .groupBy("entity_id").agg(F.max("severity").alias("severity")))


def blacklist_dimension(blacklist: DataFrame, cfg: ScoringConfig = ScoringConfig(), entity_type: str = "USER",
                        out: str = "bl_receiver_severity", materialize: bool = True) -> DataFrame | SegmentDimension:
    """Join-ready side of J1, size-checked. A list without validity: (_bl_key, <out>), one row per entity. A list with
    ``listed_at``: its :func:`segment_dimension`, so expired listings don't match."""
    if "listed_at" in blacklist.columns:
        return segment_dimension(blacklist, entity_type, cfg, materialize)
    bl = max_severity(blacklist, entity_type).select(
        F.col("entity_id").alias("_bl_key"), F.col("severity").cast("int").alias(out))
    return sized_dimension(bl, cfg.broadcast_max_rows, materialize, cfg.broadcast_max_bytes)


def enrich_with_blacklist(txn: DataFrame, blacklist: DataFrame | None, cfg: ScoringConfig = ScoringConfig(),
                          key: str = "receiver_id", entity_type: str = "USER",
                          out: str = "bl_receiver_severity", materialize: bool = True,
                          dim: DataFrame | SegmentDimension | None = None, ts: str = "event_time") -> DataFrame:
    """``dim``: a ``blacklist_dimension`` prepared earlier (then ``blacklist`` is unused)."""
    bl = dim if dim is not None else blacklist_dimension(blacklist, cfg, entity_type, out, materialize)
    if isinstance(bl, SegmentDimension):
        return _join_segments(txn, bl, entity_type, key, out, ts)
    return txn.join(bl, txn[key] == bl["_bl_key"], "left").drop("_bl_key")


def baseline_dimension(baseline: DataFrame, cfg: ScoringConfig = ScoringConfig(),
                       materialize: bool = True) -> DataFrame:
    """Join-ready side of J2: (_b_user, avg_amount, stddev_amount), size-checked."""
    b = baseline.select(F.col("user_id").alias("_b_user"), "avg_amount", "stddev_amount")
    return sized_dimension(b, cfg.broadcast_max_rows, materialize, cfg.broadcast_max_bytes)


def enrich_with_baseline(txn: DataFrame, baseline: DataFrame | None, cfg: ScoringConfig = ScoringConfig(),
                         materialize: bool = True, dim: DataFrame | None = None) -> DataFrame:
    """+ avg_amount, stddev_amount (kept) and amount_zscore. Baseline is unique per user."""
    b = dim if dim is not None else baseline_dimension(baseline, cfg, materialize)
    return (txn.join(b, txn["sender_id"] == b["_b_user"], "left").drop("_b_user")
            .withColumn("amount_zscore", zscore(mode=cfg.zero_std)))


def device_dimension(devices: DataFrame, cfg: ScoringConfig = ScoringConfig(),
                     materialize: bool = True) -> DataFrame:
    """Join-ready side of J3: (_d_user, _d_dev, _d_known), size-checked."""
    d = devices.select(F.col("user_id").alias("_d_user"), F.col("device_id").alias("_d_dev"),
                       F.lit(True).alias("_d_known"))
    return sized_dimension(d, cfg.broadcast_max_rows, materialize, cfg.broadcast_max_bytes)


def enrich_with_device(txn: DataFrame, devices: DataFrame | None, cfg: ScoringConfig = ScoringConfig(),
                       materialize: bool = True, dim: DataFrame | None = None) -> DataFrame:
    """+ is_new_device: 1 unless (sender_id, device_id) is in the device history.

    A null device never matches, so it counts as new. ``devices`` must be unique on
    (user_id, device_id); ``build_known_devices`` guarantees that.
    """
    d = dim if dim is not None else device_dimension(devices, cfg, materialize)
    cond = (txn["sender_id"] == d["_d_user"]) & (txn["device_id"] == d["_d_dev"])
    return (txn.join(d, cond, "left")
            .withColumn("is_new_device", F.when(F.col("_d_known").isNull(), F.lit(1)).otherwise(F.lit(0)))
            .drop("_d_user", "_d_dev", "_d_known"))


def add_calendar(txn: DataFrame, cfg: ScoringConfig = ScoringConfig(), ts: str = "event_time",
                 with_day: bool = False) -> DataFrame:
    """+ hour_of_day, is_weekend [, day_of_week] in UTC (or ``cfg.calendar_tz``).
    An instant (TIMESTAMP) is first turned into UTC wall-clock, so the session
    time zone never changes the result."""
    t = F.col(ts)
    if isinstance(txn.schema[ts].dataType, TimestampType):
        t = instant_to_utc_ntz(t)
    cols = calendar_columns(t, cfg.calendar_tz)
    if not with_day:
        cols.pop("day_of_week")
    return txn.withColumns(cols)


# ---- J4: DEVICE / IP blacklist --------------------------------------------------

def enrich_with_entity_blacklist(txn: DataFrame, blacklist: DataFrame, cfg: ScoringConfig = ScoringConfig(),
                                 keys: dict[str, tuple[str, str]] | None = None,
                                 materialize: bool = True) -> DataFrame:
    """Match by key only (validity ignored): max severity per listed entity. One
    reduced table for all entity types (written and size-checked once); each type's
    join reads its slice."""
    keys = keys or {"DEVICE": ("device_id", "bl_device_severity"), "IP": ("ip_address", "bl_ip_severity")}
    top = (blacklist.filter(F.col("entity_type").isin(list(keys)))
           .groupBy("entity_type", "entity_id").agg(F.max("severity").cast("int").alias("severity")))
    top = sized_dimension(top, cfg.broadcast_max_rows, materialize, cfg.broadcast_max_bytes)
    for etype, (key, out) in keys.items():
        dim = top.filter(F.col("entity_type") == etype).select(F.col("entity_id").alias("_bl_key"),
                                                               F.col("severity").alias(out))
        txn = enrich_with_blacklist(txn, None, cfg, key=key, out=out, dim=dim)
    return txn


#: Boundaries of an entity are numbered inside pieces of this length, so no entity is numbered in one task.
BOUNDARY_PIECE = "day"


def _boundaries(bl: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct starts and ends of each entity's listings, numbered from 0 in time order: keys, _at, _rank, and the
    next boundary (null after the last)."""
    points = (bl.select(*keys, F.explode(F.array("_from", "_to")).alias("_at")).filter("_at is not null").distinct()
              .withColumn("_piece", F.date_trunc(BOUNDARY_PIECE, "_at")))
    inside = Window.partitionBy(*keys, "_piece").orderBy("_at")
    points = points.withColumns({"_i": F.row_number().over(inside) - 1, "_next": F.lead("_at").over(inside)})
    pieces = points.groupBy(*keys, "_piece").agg(F.count(F.lit(1)).alias("_c"), F.min("_at").alias("_start"))
    order = Window.partitionBy(*keys).orderBy("_piece")  # one row an entity and piece
    pieces = pieces.select(*keys, "_piece", F.lead("_start").over(order).alias("_follow"),
                           F.coalesce(F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return (points.join(pieces, [*keys, "_piece"])
            .select(*keys, "_at", (F.col("_i") + F.col("_before")).cast("long").alias("_rank"),
                    F.coalesce("_next", "_follow").alias("_next")))


def validity_segments(blacklist: DataFrame, entity_type: str | list[str]) -> DataFrame:
    """Turn possibly overlapping listings [listed_at, expires_at) of the given entity
    type(s) into non-overlapping segments carrying the highest active severity.

    Between two neighbouring boundaries of an entity (starts and ends of its listings) the active listings do not
    change, so a listing covers a run of numbered gaps. The run is cut into at most two aligned blocks of each
    power of two; a block keeps the highest severity that covers it, and a gap takes the highest of the blocks that
    hold it, one a power of two. So an entity with n listings costs about n log n rows, spread over (entity, block)
    keys, whatever overlaps: listings never meet boundaries. Severities
    are taken as they are, whatever their scale; a null severity never beats another and alone gives no
    segment, as in ``max``. Work is on the list only, and a transaction then matches at most one segment, so the
    range join needs no post-join aggregation.
    Output: entity_type, entity_id, seg_start, seg_end (null = open), severity.
    """
    types = [entity_type] if isinstance(entity_type, str) else list(entity_type)
    keys = ["entity_type", "entity_id"]
    bl = (blacklist.filter(F.col("entity_type").isin(types) & F.col("listed_at").isNotNull() & F.col("severity").isNotNull())
          .select(*keys, F.col("listed_at").cast("timestamp_ntz").alias("_from"),
                  F.col("expires_at").cast("timestamp_ntz").alias("_to"), "severity")
          .filter(F.col("_to").isNull() | (F.col("_from") < F.col("_to")))
          .groupBy(*keys, "_from", "_to").agg(F.max("severity").alias("severity")))
    points = _boundaries(bl, keys)
    place = points.select(*keys, "_at", "_rank")
    last = points.groupBy(*keys).agg(F.max("_rank").alias("_last"))
    runs = (bl.join(place.select(*keys, F.col("_at").alias("_from"), F.col("_rank").alias("_a")), [*keys, "_from"])
            .join(place.select(*keys, F.col("_at").alias("_to"), F.col("_rank").alias("_b")), [*keys, "_to"], "left")
            .join(last, keys).withColumn("_b", F.coalesce("_b", F.col("_last") + 1)))
    # at power k the run [a, b) still holds the blocks from a' to b'; an odd first or last one is not part of a larger block
    low, high = "(_a + shiftleft(1L, k) - 1) div shiftleft(1L, k)", "_b div shiftleft(1L, k)"
    blocks = F.expr(f"""flatten(transform(sequence(0, cast(ceil(log2(_last + 2)) as int)), k -> array_compact(array(
        if({low} < {high} and {low} % 2 = 1, named_struct('k', k, 'i', {low}), null),
        if({low} < {high} and {high} % 2 = 1, named_struct('k', k, 'i', {high} - 1), null)))))""")
    best = (runs.select(*keys, "severity", F.explode(blocks).alias("_x")).select(*keys, "severity", "_x.k", "_x.i")
            .groupBy(*keys, "k", "i").agg(F.max("severity").alias("severity")))
    gaps = (points.join(last, keys)
            .select(*keys, "_rank", F.col("_at").alias("seg_start"), F.col("_next").alias("seg_end"),
                    F.explode(F.expr("sequence(0, cast(ceil(log2(_last + 2)) as int))")).alias("k"))
            .withColumn("i", F.expr("shiftright(_rank, k)")))
    return (gaps.join(best, [*keys, "k", "i"])
            .groupBy(*keys, "seg_start", "seg_end").agg(F.max("severity").alias("severity")))


#: Segments that an entity has in one time bin on average, beyond which its segments are binned.
SEGMENTS_PER_BIN = 8


@dataclass
class SegmentDimension:
    """Join-ready validity segments: (<keys>, _bin, _from, _to, severity), and for the entities of many segments the grid of
    time bins by which both sides are dealt: (<keys>, _low, _width, _top), None where no entity has many."""
    segments: DataFrame
    grid: DataFrame | None
    by_type: bool


def segment_dimension(blacklist: DataFrame, entity_type: str | list[str], cfg: ScoringConfig = ScoringConfig(),
                      materialize_first: bool = True, per_bin: int = SEGMENTS_PER_BIN) -> SegmentDimension:
    """Segments of the given entity types. An entity with more than ``per_bin`` segments gets equal time bins between its
    first and last boundary, about ``per_bin`` segments each; a segment stands in each bin it meets (all in all at most the
    segments plus the bins). A transaction looks in the one bin of its time, so it never meets all segments of
    its entity, and an entity with many transactions is dealt over its bins."""
    keys = ["_type", "_key"]
    seg = validity_segments(blacklist, entity_type).select(
        F.col("entity_type").alias("_type"), F.col("entity_id").alias("_key"), F.col("seg_start").alias("_from"),
        F.col("seg_end").alias("_to"), F.col("severity").cast("int").alias("severity"))
    seg = written(seg, "segments") if materialize_first else seg
    low, high = epoch_micros(F.col("_from")), epoch_micros(F.coalesce("_to", "_from"))
    grid = (seg.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(low).alias("_low"), F.max(high).alias("_high"))
            .filter(F.col("_n") > per_bin)
            .select(*keys, "_low", F.expr(f"greatest(1L, (_high - _low) div (_n div {per_bin} + 1) + 1)").alias("_width"), "_high")
            .select(*keys, "_low", "_width", F.expr("(_high - _low) div _width").alias("_top")))
    grid = sized_dimension(grid, cfg.broadcast_max_rows, materialize_first, cfg.broadcast_max_bytes)
    none = grid.isEmpty()
    if not none:
        first = _bin(low, "_low", "_width", "_top")
        final = F.when(F.col("_to").isNull(), F.coalesce("_top", F.lit(0))).otherwise(
            _bin(epoch_micros(F.col("_to")) - 1, "_low", "_width", "_top"))
        seg = seg.join(grid, keys, "left").select(*keys, F.explode(F.sequence(first, final)).alias("_bin"), "_from", "_to", "severity")
    else:
        seg = seg.withColumn("_bin", F.lit(0).cast("long"))
    seg = sized_dimension(seg, cfg.broadcast_max_rows, materialize_first, cfg.broadcast_max_bytes)
    return SegmentDimension(seg, None if none else grid, not isinstance(entity_type, str))


def _bin(us: Column, low: str, width: str, top: str) -> Column:
    """The time bin of an instant; 0 where there is no grid."""
    at = F.floor((us - F.col(low)) / F.col(width)).cast("long")
    return F.coalesce(F.least(F.greatest(at, F.lit(0).cast("long")), F.col(top)), F.lit(0).cast("long"))


def _join_segments(txn: DataFrame, dim: SegmentDimension, entity_type: str, key: str, out: str, ts: str) -> DataFrame:
    """The severity of the one segment of ``key`` that holds the transaction's time, if any."""
    t = F.col(ts).cast("timestamp_ntz")
    own = lambda d: d.filter(F.col("_type") == entity_type).drop("_type") if dim.by_type else d.drop("_type")
    seg = own(dim.segments).select(F.col("_key").alias("_s_key"), F.col("_bin").alias("_s_bin"), F.col("_from").alias("_s_from"),
                                   F.col("_to").alias("_s_to"), F.col("severity").alias(out))
    if dim.grid is None:
        txn = txn.withColumn("_s_at", F.lit(0).cast("long"))
    else:
        grid = own(dim.grid).withColumnRenamed("_key", "_g_key")
        txn = (txn.join(grid, F.col(key) == F.col("_g_key"), "left")
               .withColumn("_s_at", _bin(epoch_micros(t), "_low", "_width", "_top")).drop("_g_key", "_low", "_width", "_top"))
    cond = ((F.col(key) == F.col("_s_key")) & (F.col("_s_at") == F.col("_s_bin")) & (F.col("_s_from") <= t)
            & (F.col("_s_to").isNull() | (t < F.col("_s_to"))))
    return txn.join(seg, cond, "left").drop("_s_key", "_s_bin", "_s_from", "_s_to", "_s_at")


def enrich_with_entity_blacklist_asof(txn: DataFrame, blacklist: DataFrame, cfg: ScoringConfig = ScoringConfig(),
                                      keys: dict[str, tuple[str, str]] | None = None,
                                      ts: str = "event_time", materialize: bool = True) -> DataFrame:
    """Match only listings valid at the transaction time: listed_at <= t < expires_at
    (no expiry = open ended). Equi-join on the entity plus a range condition.

    Segments of all entity types are built in one pass, written and size-checked
    once; each type's join reads its slice of that table."""
    keys = keys or {"DEVICE": ("device_id", "bl_device_severity"), "IP": ("ip_address", "bl_ip_severity")}
    dim = segment_dimension(blacklist, list(keys), cfg, materialize)
    for etype, (key, out) in keys.items():
        txn = _join_segments(txn, dim, etype, key, out, ts)
    return txn
