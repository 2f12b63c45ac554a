"""Progress of the scoring job, batch by batch, from Spark's own reports: deliveries, redeliveries left out, rejects, and
rows held in the state (V5). The figures are observed where the rows pass anyway; no extra job counts them."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

DELIVERED, FIRST = "deliveries", "first_deliveries"


def observe_deliveries(df: DataFrame) -> DataFrame:
    rejected = F.coalesce(F.sum(F.col("reject_reason").isNotNull().cast("long")), F.lit(0))
    return df.observe(DELIVERED, F.count(F.lit(1)).alias("n_delivered"), rejected.alias("n_rejected_delivered"))


def observe_first(df: DataFrame) -> DataFrame:
    return df.observe(FIRST, F.count(F.lit(1)).alias("n_rows"))


class BatchMetrics(StreamingQueryListener):
    """Keeps a row a batch of the query called ``name``: batch_id, n_delivered, n_redelivered, n_rows, n_held (ids in the
    state). ``with BatchMetrics(spark, name) as metrics`` listens while the block runs."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self._rows, self._ended = spark, name, {}, threading.Event()
        self._run_id = None

    def __enter__(self) -> BatchMetrics:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *exc) -> None:
        if exc[0] is None:
            self._ended.wait(60)  # reports come after the query ended
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self._run_id = str(event.runId)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name != self.name or DELIVERED not in p.observedMetrics:
            return
        delivered, first = p.observedMetrics[DELIVERED], p.observedMetrics.get(FIRST)
        rows = first["n_rows"] if first is not None else delivered["n_delivered"]
        if delivered["n_delivered"]:
            self._rows[p.batchId] = (p.batchId, delivered["n_delivered"], delivered["n_delivered"] - rows, rows,
                                     sum(s.numRowsTotal for s in p.stateOperators))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self._run_id:
            self._ended.set()

    def rows(self) -> list[tuple[int, int, int, int, int]]:
        return [self._rows[i] for i in sorted(self._rows)]

    def frame(self) -> DataFrame:
        return self.spark.createDataFrame(
            self.rows(), "batch_id long, n_delivered long, n_redelivered long, n_rows long, n_held long")
