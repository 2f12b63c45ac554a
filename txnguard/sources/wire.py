"""Wire format (Kafka-style ``value`` binary JSON + ``timestamp``), parsing,
reject split and redelivery handling.

``read_transactions`` keeps the source format pluggable: ``kafka`` with the
original options, or any file format (the Kafka connector jar is not installed
here, so the tests drive the same parse through a file source).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnguard.config import FixtureSpec, ScoringConfig
from txnguard.functions.expressions import utc_ntz_to_instant
from txnguard.schemas import REQUIRED_FIELDS, TRANSACTION_FIELDS, TRANSACTION_SCHEMA

WIRE_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS"   # fixed value: producer text format, UTC, no zone
PARSE_OPTIONS = {"timestampFormat": WIRE_TIME_FORMAT, "timeZone": "UTC", "mode": "PERMISSIVE"}
WIRE_SCHEMA = "value binary, timestamp timestamp"


def _payload(cols: dict[str, Column]) -> Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in cols.items()]))


def payload_columns(drop: tuple[str, ...] = ()) -> dict[str, Column]:
    cols = {}
    for name in TRANSACTION_FIELDS:
        if name in drop:
            continue
        c = F.col(name)
        if name in ("event_time", "ingest_time"):
            c = F.date_format(c, WIRE_TIME_FORMAT)
        cols[name] = c
    return cols


def wire_rows(src: DataFrame, spec: FixtureSpec = FixtureSpec(), faults: bool = False,
              duplicates: bool = False, keep_source_id: bool = False) -> DataFrame:
    """value (JSON as UTF-8 bytes) + timestamp (delivery time = ingest_time).

    faults: rows with event_id % fault_mod = 0 are corrupted by variant
      (event_id div fault_mod) % 4: 0 garbage text, 1 missing sender_id,
      2 amount of the wrong type, 3 null value.
    duplicates: rows with event_id % duplicate_mod = 0 are delivered a second
      time 5 seconds later (at-least-once redelivery).
    """
    eid = F.col("event_id")
    clean = _payload(payload_columns())
    value = clean
    if faults:
        variant = F.floor(eid / spec.fault_mod) % 4
        missing = _payload(payload_columns(drop=("sender_id",)))
        wrong = _payload({**payload_columns(), "amount": F.concat(F.lit("x"), F.col("amount").cast("string"))})
        value = (F.when(eid % spec.fault_mod != 0, clean)
                 .when(variant == 0, F.concat(F.lit("{not json "), F.col("txn_id")))
                 .when(variant == 1, missing)
                 .when(variant == 2, wrong)
                 .otherwise(F.lit(None).cast("string")))
    delivered = utc_ntz_to_instant(F.col("ingest_time"))
    out = src.select(*(["event_id"] if keep_source_id or duplicates else []),
                     F.encode(value, "UTF-8").alias("value"), delivered.alias("timestamp"))
    if duplicates:
        again = (out.filter(F.col("event_id") % spec.duplicate_mod == 0)
                 .withColumn("timestamp", F.timestamp_add("SECOND", F.lit(5), F.col("timestamp"))))
        out = out.unionByName(again)
        if not keep_source_id:
            out = out.drop("event_id")
    return out


def read_transactions(spark: SparkSession, fmt: str = "kafka", path: str | None = None,
                      options: dict | None = None, cfg: ScoringConfig = ScoringConfig(),
                      streaming: bool = True) -> DataFrame:
    """Raw wire rows (value, timestamp) from Kafka or files.

    Kafka defaults follow the original: topic ``transactions``, start at latest,
    maxOffsetsPerTrigger, no failure on data loss. Unverified here (no connector).
    """
    if fmt == "kafka":
        opts = {"kafka.bootstrap.servers": "localhost:9092", "subscribe": "transactions",
                "startingOffsets": "latest", "maxOffsetsPerTrigger": str(cfg.max_offsets_per_trigger),
                "failOnDataLoss": "false", **(options or {})}
        reader = spark.readStream if streaming else spark.read
        return reader.format("kafka").options(**opts).load().select("value", "timestamp")
    opts = dict(options or {})
    if streaming:
        reader = spark.readStream.format(fmt).schema(WIRE_SCHEMA).options(**opts)
        return reader.load(path)
    return spark.read.format(fmt).schema(WIRE_SCHEMA).options(**opts).load(path)


def parse_transactions(raw: DataFrame, watermark: str | None = None, keep_raw: bool = False,
                       repartition: int | None = None) -> DataFrame:
    """value -> 16 transaction fields (+ kafka_ts [, raw_value]). Malformed JSON gives
    an all-null row, a bad field a null field (PERMISSIVE); times are read as UTC text.

    ``repartition``: hash-repartition by sender_id into that many partitions (the
    original always did, into 4). Off by default: no later step needs rows grouped
    by sender alone (joins are broadcast or keyed differently, velocity keys by
    sender and time bucket), so it would only add a shuffle."""
    text = F.col("value").cast("string")
    parsed = (raw.select(F.from_json(text, TRANSACTION_SCHEMA, PARSE_OPTIONS).alias("data"),
                         F.col("timestamp").alias("kafka_ts"),
                         *([text.alias("raw_value")] if keep_raw else []))
              .select("data.*", "kafka_ts", *(["raw_value"] if keep_raw else [])))
    if watermark:
        parsed = parsed.withWatermark("event_time", watermark)
    if repartition:
        parsed = parsed.repartition(repartition, "sender_id")
    return parsed


def reject_reason() -> Column:
    """'malformed' when nothing parsed, 'missing_required' when a required field is
    null, else null (valid)."""
    all_null = F.lit(True)
    for c in TRANSACTION_FIELDS:
        all_null = all_null & F.col(c).isNull()
    some_required_null = F.lit(False)
    for c in REQUIRED_FIELDS:
        some_required_null = some_required_null | F.col(c).isNull()
    return F.when(all_null, F.lit("malformed")).when(some_required_null, F.lit("missing_required"))


def first_delivery(parsed: DataFrame, key: str = "txn_id", order: str = "kafka_ts") -> DataFrame:
    """Batch de-duplication of redelivered transactions: keep the earliest delivery
    per ``key`` plus the number of copies; of deliveries at one time, the least in its other columns. An aggregate
    (partial per partition, then final), so a key delivered very many times is combined map-side.
    A null key identifies nothing: such rows all stay, with n_copies 1. The input is read once."""
    others = [c for c in parsed.columns if c not in (key, order)]
    own = F.when(F.col(key).isNull(), F.monotonically_increasing_id())  # tells rows without a key apart
    return (parsed.withColumn("_own", own).groupBy(key, "_own")
            .agg(F.min(F.struct(order, *others)).alias("_first"), F.count(F.lit(1)).alias("n_copies"))
            .select(key, *[F.col("_first")[c].alias(c) for c in parsed.columns if c != key], "n_copies"))
