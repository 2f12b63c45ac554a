"""Sender velocity.

* ``sliding_velocity`` (A1/A2): per sender and sliding event-time window, like the
  original's 1 min / 30 s and 10 min / 1 min aggregates. A batch is first summed into
  panes of the slide's length (one row a sender and pane leaves a task, however many windows
  hold it); a window is put together from its neighbouring panes. A stream uses Spark's own window.
* ``trailing_velocity`` (V3): per transaction, count / sum / avg / stddev of the same
  sender over [t - d, t] (ties count, the row itself counts).
* ``self_velocity`` (P6): the original placeholder (count 1, totals = amount).

The trailing window is a difference of running sums: each row adds its amount at t and takes it back just after
t + d, so the sum up to t holds what lies in [t - d, t]. Running sums are taken inside (sender, time slice), and
the totals of the slices before are added to them. The work is linear in the rows however many a window
holds, and a slice may be shorter than the window, so a hot sender's rows, even those of one window, are split
over many tasks. Only the adding row carries the payment's columns; those that take back carry key, time and
amount. Amounts are money and are taken at four decimals, as whole numbers; all sums are exact, so
taking back leaves no rounding error and the order of rows doesn't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from txnguard.config import ScoringConfig, duration_micros
from txnguard.functions.expressions import epoch_micros, instant_to_utc_ntz


def sliding_velocity(df: DataFrame, size: str, slide: str, suffix: str = "1m",
                     key: str = "sender_id", ts: str = "event_time", full: bool = False,
                     end_col: str | None = None) -> DataFrame:
    """key, window end, txn_count, total_amount [, avg_amount, stddev_amount] of every window that holds a row."""
    end_col = end_col or ("window_end" if suffix == "1m" else f"window_end_{suffix}")
    if not df.isStreaming and duration_micros(size) % duration_micros(slide) == 0:
        return _paned(df, duration_micros(size), duration_micros(slide), suffix, key, ts, full, end_col)
    aggs = {f"txn_count_{suffix}": F.count(F.lit(1)),
            f"total_amount_{suffix}": F.sum("amount")}
    if full:
        aggs[f"avg_amount_{suffix}"] = F.avg("amount")
        aggs[f"stddev_amount_{suffix}"] = F.stddev_samp("amount")
    return (df.groupBy(F.col(key), F.window(F.col(ts), size, slide))
            .agg(*[c.alias(n) for n, c in aggs.items()])
            .select(key, F.col("window.end").alias(end_col), *aggs))


def _paned(df: DataFrame, size: int, slide: int, suffix: str, key: str, ts: str, full: bool, end_col: str) -> DataFrame:
    """Panes (count, known amounts, sum, mean, squared deviations), dealt by sender, so that the windows of a sender are
    summed where its panes are. A window's squared deviations are those of its panes and of the panes' means."""
    ntz = isinstance(df.schema[ts].dataType, TimestampNTZType)
    us = epoch_micros(ts, ntz=ntz)
    panes = (df.filter(F.col(ts).isNotNull())
             .groupBy(F.col(key).alias("_key"), F.floor(us / slide).alias("_pane"))
             .agg(F.count(F.lit(1)).alias("_n"), F.count("amount").alias("_k"), F.sum("amount").alias("_s"),
                  *([F.avg("amount").alias("_m"), (F.var_pop("amount") * F.count("amount")).alias("_d")] if full else [])))
    spans = size // slide
    windows = (panes.repartition("_key")
               .withColumn("_w", F.explode(F.sequence(F.col("_pane") - (spans - 1), F.col("_pane")))))
    known = F.col("_k") > 0
    parts = [F.sum("_n").alias("_n"), F.sum("_k").alias("_k"), F.sum("_s").alias("_s")]
    if full:  # at most size / slide panes in a window
        parts.append(F.collect_list(F.when(known, F.struct("_k", "_m", "_d"))).alias("_p"))
    grouped = windows.groupBy("_key", "_w").agg(*parts)
    mean = F.col("_s") / F.nullif(F.col("_k"), F.lit(0))
    out = {f"txn_count_{suffix}": F.col("_n"), f"total_amount_{suffix}": F.col("_s")}
    if full:
        squares = F.aggregate("_p", F.lit(0.0), lambda a, p: a + p["_d"] + p["_k"] * (p["_m"] - mean) * (p["_m"] - mean))
        out[f"avg_amount_{suffix}"] = F.when(known, mean)
        out[f"stddev_amount_{suffix}"] = F.when(F.col("_k") > 1, F.sqrt(squares / (F.col("_k") - 1)))
    end = F.timestamp_micros(F.col("_w") * slide + size)
    end = instant_to_utc_ntz(end) if ntz else end
    return grouped.select(F.col("_key").alias(key), end.alias(end_col), *[c.alias(n) for n, c in out.items()])


#: Whole units of an amount's fourth decimal.
UNITS = 10_000


def amount_units(amount: str) -> Column:
    """The amount in whole units; null for one that is null, not finite, or beyond a long (about 9.2e14)."""
    return F.round(F.col(amount) * UNITS).try_cast("long")


def signed_parts(short: Column, long: Column, x: Column) -> dict[str, Column]:
    """What a row adds to (or, with -1, takes from) the running sums of the short and the long window."""
    known, units = F.when(x.isNull(), 0).otherwise(1), F.coalesce(x, F.lit(0).cast("long"))
    return {"_n1": short, "_n2": long, "_k1": short * known, "_k2": long * known, "_s1": short * units, "_s2": long * units,
            "_q2": long * units.cast("decimal(19,0)") * units.cast("decimal(19,0)")}


def velocity_columns(n1: Column, n2: Column, k1: Column, k2: Column, s1: Column, s2: Column, q2: Column) -> dict[str, Column]:
    """The six velocity columns from a row's window sums, in the order of :func:`signed_parts`."""
    spread = k2.cast("decimal(10,0)") * q2.cast("decimal(38,0)") - s2.cast("decimal(19,0)") * s2.cast("decimal(19,0)")
    variance = spread.cast("double") / (k2 * (k2 - 1)).cast("double") / F.lit(float(UNITS) ** 2)
    units = F.lit(float(UNITS))
    return {"txn_count_1m": n1.cast("int"),
            "total_amount_1m": F.when(k1 > 0, s1.cast("double") / units),
            "txn_count_10m": n2.cast("int"),
            "total_amount_10m": F.when(k2 > 0, s2.cast("double") / units),
            "avg_amount_10m": F.when(k2 > 0, s2.cast("double") / k2.cast("double") / units),
            "stddev_amount_10m": F.when(k2 > 1, F.sqrt(variance))}


def trailing_velocity(df: DataFrame, cfg: ScoringConfig = ScoringConfig(), key: str = "sender_id",
                      ts: str = "event_time", amount: str = "amount") -> DataFrame:
    """Adds txn_count_1m, total_amount_1m, txn_count_10m, total_amount_10m,
    avg_amount_10m, stddev_amount_10m (names of the original; the spans are
    ``cfg.short_window`` / ``cfg.long_window``, slices ``cfg.velocity_slice``).

    A null or non-finite amount, or one beyond 9.2e14, counts as a row but not in sums; rows without a sender or
    time have no velocity."""
    d1, d2, width = cfg.short_micros, cfg.long_micros, cfg.slice_micros
    us = epoch_micros(ts, ntz=isinstance(df.schema[ts].dataType, TimestampNTZType))
    rows = df.select(*df.columns, us.alias("_v_t"), amount_units(amount).alias("_v_x"))
    usable = F.col(key).isNotNull() & F.col("_v_t").isNotNull()

    def change(at: int, short: int, long: int):
        return F.struct((F.col("_v_t") + at).alias("t"), F.lit(short).alias("short"), F.lit(long).alias("long"))

    own = (F.col("_v.short") == 1) & (F.col("_v.long") == 1)
    changes = (rows.filter(usable)
               .withColumn("_v", F.explode(F.array(change(0, 1, 1), change(d1 + 1, -1, 0), change(d2 + 1, 0, -1))))
               .select(*[F.col(c) if c == key else F.when(own, F.col(c)).alias(c) for c in df.columns],
                       "_v_x", "_v", own.alias("_v_own"), F.floor(F.col("_v.t") / width).alias("_v_slice")))
    parts = signed_parts(F.col("_v.short"), F.col("_v.long"), F.col("_v_x"))
    totals = (changes.groupBy(F.col(key).alias("_o_key"), F.col("_v_slice").alias("_o_slice"))
              .agg(*[F.sum(v).alias(n) for n, v in parts.items()]))
    before = Window.partitionBy("_o_key").orderBy("_o_slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_o_key", "_o_slice", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_o{n}")
                                                   for n in parts])
    upto = (Window.partitionBy(key, "_v_slice").orderBy(F.col("_v.t"))
            .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    own = (changes.withColumns({n: F.sum(v).over(upto) for n, v in parts.items()}).filter("_v_own")
           .join(totals, (F.col(key) == F.col("_o_key")) & (F.col("_v_slice") == F.col("_o_slice"))))
    out = velocity_columns(*[F.col(n) + F.col(f"_o{n}") for n in parts])
    scored = own.select(*df.columns, *[v.alias(n) for n, v in out.items()])
    if not df.schema[key].nullable and not df.schema[ts].nullable:
        return scored
    rest = rows.filter(~usable).select(*df.columns, *[F.lit(None).cast(scored.schema[n].dataType).alias(n) for n in out])
    return scored.unionByName(rest)


def self_velocity(df: DataFrame) -> DataFrame:
    """Placeholder of the original job: each row counts as one transaction; avg/stddev
    are copied from the user baseline (needs avg_amount / stddev_amount)."""
    return df.withColumns({
        "txn_count_1m": F.lit(1),
        "total_amount_1m": F.col("amount"),
        "txn_count_10m": F.lit(1),
        "total_amount_10m": F.col("amount"),
        "avg_amount_10m": F.col("avg_amount"),
        "stddev_amount_10m": F.col("stddev_amount"),
    })
