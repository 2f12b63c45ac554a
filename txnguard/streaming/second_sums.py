"""Per-row trailing velocity of micro-batches from summaries: what is kept of a sender is one row a second.

Two tables grow by what a batch brings (:class:`~txnguard.streaming.batch_tables.BatchTable`): the sums of each
(sender, second), made by a Spark aggregate, and the bare rows (sender, time, amount). The window [t - d, t] of a new
row is the sum of the whole seconds from that of t - d up to the second before t, less the rows of the
first second that lie before t - d, plus the rows of its own second up to t. So bare rows are read only of the
seconds at the windows' edges, in groups of one sender and second; the whole seconds of a sender are
one running sum whose length is the window's, not the sender's rate. A hot sender's rows are dealt over its seconds, what is
written follows the batch, and all sums are whole numbers (see ``operators.velocity``).

A row's time may lie behind rows seen before: its window is summed over all rows held, and it is marked ``late`` if it lies
behind the watermark (the latest time of the batches before, less the delay). Rows are held until they are older
than the watermark by the long window and ``cfg.allowed_lateness``. A replayed batch replaces what it wrote and
sees the batches before it, so it gives the same rows again. Rows without a sender or time get no velocity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType, TimestampNTZType

from txnguard.config import ScoringConfig, duration_micros
from txnguard.functions.expressions import epoch_micros
from txnguard.operators.velocity import amount_units, signed_parts, velocity_columns
from txnguard.streaming.batch_tables import BatchTable

ROWS = StructType().add("key", "string").add("us", "long").add("x", "long").add("slot", "long")
SECONDS = (StructType().add("key", "string").add("sec", "long").add("n", "long").add("k", "long").add("s", "long")
           .add("q", DecimalType(38, 0)).add("slot", "long"))
#: Rows of a batch that one task writes to the state.
FILE_ROWS = 1_000_000


class SecondSums:
    """State of a stream's velocity under ``root``. ``unit``: the length of a summary, a divisor of both windows."""

    def __init__(self, spark: SparkSession, root: str, cfg: ScoringConfig = ScoringConfig(), key: str = "sender_id",
                 ts: str = "event_time", amount: str = "amount", unit: str = "1 second", compact_every: int = 50):
        self.cfg, self.key, self.ts, self.amount, self.compact_every = cfg, key, ts, amount, compact_every
        self.unit = duration_micros(unit)
        if cfg.short_micros % self.unit or cfg.long_micros % self.unit:
            raise ValueError(f"{unit} does not divide the windows {cfg.short_window} and {cfg.long_window}")
        self.slot = cfg.short_micros // self.unit  # summaries of one folder
        self.rows = BatchTable(spark, f"{root}/rows", ["slot"])
        self.seconds = BatchTable(spark, f"{root}/seconds", ["slot"])

    def watermark(self, batch_id: int) -> int | None:
        """Microseconds behind which a row of this batch is late."""
        seen = [p["stats"]["max_us"] for p in self.rows.parts() if p["last"] < batch_id and "max_us" in p["stats"]]
        return (max(seen) - duration_micros(self.cfg.watermark)) // 1000 * 1000 if seen else None

    def add(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """The rows of ``batch`` with ``late`` and the six velocity columns; the batch is part of the state then."""
        d1, d2, unit = self.cfg.short_micros, self.cfg.long_micros, self.unit
        us = epoch_micros(self.ts, ntz=isinstance(batch.schema[self.ts].dataType, TimestampNTZType))
        batch = batch.withColumn("_us", us)
        mark = self.watermark(batch_id)
        bare = batch.select(F.col(self.key).cast("string").alias("key"), F.col("_us").alias("us"),
                            amount_units(self.amount).alias("x"), F.floor(F.col("_us") / (unit * self.slot)).alias("slot"))
        n_rows, top = batch.agg(F.count(F.lit(1)), F.max("_us")).first()
        # a task writes a file a slot: as many tasks as cores, not as shuffle partitions
        tasks = max(batch.sparkSession.sparkContext.defaultParallelism, -(-n_rows // FILE_ROWS))
        part = self.rows.append(bare.filter("key is not null and us is not null").coalesce(tasks), batch_id,
                                {} if top is None else {"max_us": top})
        mine = [int(f.split("=")[1]) for f in part["folders"]]
        new = self._of(self.rows, ROWS, batch_id, batch_id, mine)
        x = signed_parts(F.lit(1), F.lit(1), F.col("x"))
        sums = (new.groupBy("key", F.floor(F.col("us") / unit).alias("sec"), "slot")
                .agg(F.sum(x["_n2"]).alias("n"), F.sum(x["_k2"]).alias("k"), F.sum(x["_s2"]).alias("s"),
                     F.sum(x["_q2"]).cast("decimal(38,0)").alias("q")))
        self.seconds.append(sums, batch_id)
        touched = self._of(self.seconds, SECONDS, batch_id, batch_id, mine).select("key", "sec")  # once each in a part

        base = self._whole_seconds(touched, batch_id, mine)
        edge = self._edge_seconds(new, touched, batch_id, mine)
        names = list(signed_parts(F.lit(0), F.lit(0), F.lit(0)))
        sums = edge.join(base, ["key", "sec"]).select(
            F.col("key").alias("_key"), F.col("us").alias("_at"),
            *[c.alias(n) for n, c in velocity_columns(*[F.col(n) + F.col(f"_b{n}") for n in names]).items()])
        late = F.lit(False) if mark is None else F.coalesce(F.col("_us") < mark, F.lit(False))
        out = (batch.join(sums, (F.col(self.key) == F.col("_key")) & (F.col("_us") == F.col("_at")), "left")
               .withColumn("late", late).drop("_key", "_at", "_us"))
        return out.select(*[c for c in batch.columns if c != "_us"], "late", *sums.columns[2:])

    def tidy(self, batch_id: int) -> None:
        """After a batch is through: leave out what no window reaches any more, and compact now and then."""
        mark = self.watermark(batch_id + 1)
        if mark is not None:
            hold = mark - self.cfg.long_micros - self.cfg.lateness_micros
            last = hold // (self.unit * self.slot) - 1
            for table in (self.rows, self.seconds):
                table.expire(lambda folder: int(folder.split("=")[1]) < last)
        for table in (self.rows, self.seconds):
            if len(table.parts()) > self.compact_every:
                table.compact()
                table.vacuum()

    # ---- parts of the plan -------------------------------------------------------

    @staticmethod
    def _of(table: BatchTable, schema: StructType, first: int, last: int, slots) -> DataFrame:
        """Rows of the batches from ``first`` to ``last`` in the slots; only their folders are listed and read."""
        wanted = set(slots)
        parts = [p for p in table.parts() if p["first"] >= first and p["last"] <= last]
        rows = table._rows(parts, lambda f: int(f.split("=")[1]) in wanted, schema)
        return table.spark.createDataFrame([], schema) if rows is None else rows.select(*schema.fieldNames())

    def _slots_back(self, slots: list[int], micros: int) -> set[int]:
        """Slots that hold the times ``micros`` before those of ``slots``."""
        span = self.unit * self.slot
        return {q for s in slots for q in ((s * span - micros) // span, ((s + 1) * span - 1 - micros) // span)}

    def _whole_seconds(self, touched: DataFrame, batch_id: int, mine: list[int]) -> DataFrame:
        """For each (key, sec): the sums of the whole seconds of both windows before it, from that of sec - d on."""
        d1, d2 = self.cfg.short_micros // self.unit, self.cfg.long_micros // self.unit
        back = range(0, max(d1, d2) // self.slot + 2)
        held = self._of(self.seconds, SECONDS, 0, batch_id, {s - b for s in mine for b in back})
        held = held.join(touched.select("key").distinct(), "key", "left_semi")

        def change(at: int, short: int, long: int):
            return F.struct((F.col("sec") + at).alias("sec"), F.lit(short).alias("short"), F.lit(long).alias("long"))

        events = (held.withColumn("e", F.explode(F.array(change(1, 1, 1), change(d1 + 1, -1, 0), change(d2 + 1, 0, -1))))
                  .select("key", "e.sec", "e.short", "e.long", "n", "k", "s", "q", F.lit(False).alias("asked")))
        nothing = [F.lit(0).cast(t).alias(c) for c, t in (("n", "long"), ("k", "long"), ("s", "long"), ("q", "decimal(38,0)"))]
        asked = touched.select("key", "sec", F.lit(0).alias("short"), F.lit(0).alias("long"), *nothing, F.lit(True).alias("asked"))
        upto = Window.partitionBy("key").orderBy("sec").rangeBetween(Window.unboundedPreceding, Window.currentRow)
        short, long = F.col("short"), F.col("long")
        sums = {"_n1": short * F.col("n"), "_n2": long * F.col("n"), "_k1": short * F.col("k"), "_k2": long * F.col("k"),
                "_s1": short * F.col("s"), "_s2": long * F.col("s"), "_q2": F.when(long != 0, F.when(long > 0, F.col("q")).otherwise(-F.col("q"))).otherwise(0)}
        return (events.unionByName(asked).withColumns({f"_b{n}": F.sum(c).over(upto) for n, c in sums.items()})
                .filter("asked").select("key", "sec", *[f"_b{n}" for n in sums]))

    def _edge_seconds(self, new: DataFrame, touched: DataFrame, batch_id: int, mine: list[int]) -> DataFrame:
        """For each (key, us) of the batch: its second's rows up to it, less those of the windows' first seconds that lie
        before the window."""
        d1, d2, unit = self.cfg.short_micros, self.cfg.long_micros, self.unit
        slots = set(mine) | self._slots_back(mine, d1) | self._slots_back(mine, d2)
        held = self._of(self.rows, ROWS, 0, batch_id, slots).withColumn("sec", F.floor(F.col("us") / unit))

        def change(at: int, seconds: int, short: int, long: int):
            return F.struct((F.col("us") + at).alias("us"), (F.col("sec") + seconds).alias("sec"),
                            F.lit(short).alias("short"), F.lit(long).alias("long"))

        events = (held.withColumn("e", F.explode(F.array(change(0, 0, 1, 1), change(d1 + 1, d1 // unit, -1, 0),
                                                         change(d2 + 1, d2 // unit, 0, -1))))
                  .select("key", "e.us", "e.sec", "e.short", "e.long", "x", F.lit(False).alias("asked"))
                  .filter(F.floor(F.col("us") / unit) == F.col("sec"))  # else it is gone with its whole second
                  .join(touched, ["key", "sec"], "left_semi"))
        asked = new.select("key", "us", F.floor(F.col("us") / unit).alias("sec"), F.lit(0).alias("short"), F.lit(0).alias("long"),
                           F.lit(None).cast("long").alias("x"), F.lit(True).alias("asked")).distinct()
        upto = Window.partitionBy("key", "sec").orderBy("us").rangeBetween(Window.unboundedPreceding, Window.currentRow)
        parts = signed_parts(F.col("short"), F.col("long"), F.col("x"))
        return (events.unionByName(asked).withColumns({n: F.sum(c).over(upto) for n, c in parts.items()})
                .filter("asked").select("key", "sec", "us", *parts))
