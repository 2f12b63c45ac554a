"""The streaming scoring job: one query, several sinks.

raw (Kafka / files) -> parse -> reject tag -> first delivery of each txn_id (state keyed by the id alone)
-> foreachBatch:
    trailing velocity from summaries a second (late rows are kept and marked)
    rejects -> rejects/batch_id=N
    rows and late rows of the batch -> stats/batch_id=N
    valid   -> blacklist, baseline, device, calendar, [model], rules, blend
            -> alerts/batch_id=N (final >= threshold), safe/batch_id=N (rest),
               optional alert table by date, JDBC append of the safe rows, console print.

The original ran two queries (console + Parquet) that each read, parsed and
scored every record; here the scored batch is persisted once and written to every
sink. Per-batch overwrite makes replays after a failure idempotent. Reference
tables are static snapshots, reloaded (and size-checked) every ``refresh_seconds``.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from datetime import datetime
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnguard.config import ModelConfig, ScoringConfig
from txnguard.functions.expressions import instant_literal, instant_to_utc_ntz
from txnguard.plans.scoring import JoinDimensions, ReferenceTables, alerts, join_dimensions, safe_rows, score
from txnguard.sources.sinks import write_batch_parquet, write_jdbc
from txnguard.sources.wire import parse_transactions, reject_reason
from txnguard.streaming.batch_tables import BatchTable
from txnguard.streaming.metrics import observe_deliveries, observe_first
from txnguard.streaming.second_sums import SecondSums


@dataclass
class JobPaths:
    root: str

    @property
    def alerts(self) -> str:
        return f"{self.root}/alerts"

    @property
    def safe(self) -> str:
        return f"{self.root}/safe"

    @property
    def rejects(self) -> str:
        return f"{self.root}/rejects"

    @property
    def stats(self) -> str:
        """Per batch: distinct deliveries, and how many of them were late, rejected, scored."""
        return f"{self.root}/stats"

    @property
    def alert_table(self) -> str:
        """Alerts under date folders, with a committed list of the batches that count."""
        return f"{self.root}/alert_table"

    @property
    def velocity(self) -> str:
        return f"{self.root}/_velocity"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/_checkpoint"


@dataclass
class ReferenceCache:
    """Loads reference tables on first use and again after ``refresh_seconds``.
    Each load is reduced to the join-ready dimensions, written once into the shared
    folder (unless they are snapshots already) and size-checked once; every
    micro-batch until the next refresh joins them with the same broadcast decision."""
    loader: Callable[[], ReferenceTables]
    cfg: ScoringConfig
    refresh_seconds: float = 300.0
    _dims: JoinDimensions | None = field(default=None, init=False)
    _at: float = field(default=0.0, init=False)

    def get(self) -> JoinDimensions:
        if self._dims is None or time.time() - self._at > self.refresh_seconds:
            self._dims = join_dimensions(self.loader(), self.cfg, materialize=True)
            self._at = time.time()
        return self._dims


def first_deliveries(stream: DataFrame, cfg: ScoringConfig = ScoringConfig(), key: str = "txn_id") -> DataFrame:
    """Leaves out redeliveries: rows whose ``key`` arrived before, within ``cfg.dedup_horizon``, whatever else
    differs in them (sender, time, amount). The state is Spark's, keyed by the id alone. Its clock is the arrival
    (the time of the batch), so no row is ever late for it. Rows without a key are never merged."""
    own = F.when(F.col(key).isNotNull(), F.concat(F.lit("="), F.col(key))).otherwise(F.concat(F.lit("#"), F.uuid()))
    return (stream.withColumns({"_own": own, "_arrived": F.current_timestamp()})
            .withWatermark("_arrived", cfg.dedup_horizon)
            .dropDuplicatesWithinWatermark(["_own"]).drop("_own", "_arrived"))


def prepared_stream(raw: DataFrame, cfg: ScoringConfig = ScoringConfig(), dedup: bool = True) -> DataFrame:
    """Streaming part of the job. Each delivered row comes out once, late or not; only redeliveries of a known
    transaction id are left out."""
    reason = reject_reason()
    tagged = (parse_transactions(raw, keep_raw=True)
              .withColumn("reject_reason", reason)
              .withColumn("raw_value", F.when(F.col("reject_reason").isNotNull(), F.col("raw_value")))
              .withColumn("_et", F.coalesce(F.col("event_time"), F.col("kafka_ts")))
              .withColumn("_vk", F.when(F.col("reject_reason").isNull(), F.col("sender_id"))))
    tagged = observe_deliveries(tagged)
    return observe_first(first_deliveries(tagged, cfg) if dedup else tagged)


def make_batch_writer(paths: JobPaths, refs: ReferenceCache, cfg: ScoringConfig, model=None,
                      score_from: datetime | None = None, jdbc: dict | None = None,
                      console: bool = False, mcfg: ModelConfig = ModelConfig(), velocity: SecondSums | None = None,
                      alert_table: BatchTable | None = None) -> Callable[[DataFrame, int], None]:
    """``velocity``: adds the velocity columns (without it the batch has them). ``alert_table``: takes the alerts by
    date as well, one committed part a batch."""
    def write(arrived: DataFrame, batch_id: int) -> None:
        arrived = arrived.persist()
        batch = scored = None
        try:
            if arrived.isEmpty():  # no-data batch: nothing to write
                return
            batch = arrived if velocity is None else velocity.add(arrived, batch_id).persist()
            write_batch_parquet(batch.filter(F.col("reject_reason").isNotNull())
                                .select("raw_value", "kafka_ts", "reject_reason"), paths.rejects, batch_id)
            late = F.coalesce(F.col("late"), F.lit(False)) if "late" in batch.columns else F.lit(False)
            rejected = F.col("reject_reason").isNotNull()
            write_batch_parquet(batch.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(late.cast("long")).alias("n_late"),
                                          F.sum(rejected.cast("long")).alias("n_rejected")), paths.stats, batch_id)
            valid = (batch.filter(F.col("reject_reason").isNull())
                     .drop("reject_reason", "raw_value", "late", "_et", "_vk"))
            if score_from is not None:
                valid = valid.filter(F.col("event_time") >= instant_literal(score_from))
            scored = score(valid, refs.get(), cfg.with_(velocity_mode="given"), model=model, mcfg=mcfg).persist()
            write_batch_parquet(alerts(scored, cfg), paths.alerts, batch_id)
            if alert_table is not None:
                dated = scored.withColumn("date", F.to_date(instant_to_utc_ntz("event_time")).cast("string"))
                alert_table.append(alerts(dated, cfg, ("date",)), batch_id)
            safe = safe_rows(scored, cfg)
            write_batch_parquet(safe, paths.safe, batch_id)
            if jdbc:
                write_jdbc(safe, jdbc["url"], jdbc["table"], jdbc.get("properties"))
            if console:
                scored.select(*alerts(scored, cfg).columns).show(20, truncate=False)
            if velocity is not None:
                velocity.tidy(batch_id)
        finally:
            for df in (scored, batch, arrived):
                if df is not None:
                    df.unpersist()
    return write


def start_scoring_job(spark: SparkSession, raw: DataFrame, reference_loader: Callable[[], ReferenceTables],
                      paths: JobPaths, cfg: ScoringConfig = ScoringConfig(), model=None,
                      score_from: datetime | None = None, jdbc: dict | None = None, console: bool = False,
                      available_now: bool = False, refresh_seconds: float = 300.0, name: str = "txn_scoring",
                      mcfg: ModelConfig = ModelConfig(), dated_alerts: bool = False):
    refs = ReferenceCache(reference_loader, cfg, refresh_seconds)
    velocity = SecondSums(spark, paths.velocity, cfg, key="_vk", ts="_et")
    table = BatchTable(spark, paths.alert_table, ["date"]) if dated_alerts else None
    writer = make_batch_writer(paths, refs, cfg, model, score_from, jdbc, console, mcfg, velocity, table)
    w = (prepared_stream(raw, cfg).writeStream.queryName(name)
         .option("checkpointLocation", paths.checkpoint)
         .foreachBatch(writer))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=cfg.trigger_interval)
    return w.start()
