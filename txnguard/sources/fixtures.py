"""Transactions and reference tables derived from the driver's ``events`` table.

The driver data has no payment table, so each ``events`` row becomes one payment
(integer arithmetic only, so that Spark and DuckDB derive identical rows). The
same rules are written as DuckDB SQL in ``txnguard.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnguard.config import FixtureSpec
from txnguard.functions.expressions import ntz_literal
from txnguard.schemas import TRANSACTION_FIELDS
from txnguard.sources.reference import build_baseline, build_known_devices
from txnguard.sources.tables import read_table

# Category domains of the payment fields.
CURRENCIES = ["VND", "USD", "EUR"]
CHANNELS = ["APP", "WEB", "USSD"]
DEVICE_TYPES = ["ANDROID", "IOS", "BROWSER"]
MERCHANT_CATS = ["RETAIL", "FOOD", "TRAVEL", "FINANCE", "GAMING"]


def _pick(values: list[str], index: Column) -> Column:
    return F.array(*[F.lit(v) for v in values])[index.cast("int")]


def _pad(prefix: str, num: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(num.cast("string"), width, "0"))


def transaction_source(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """events -> 16 payment fields plus the source keys (event_id, user_id, k).

    ``event_time`` keeps the TIMESTAMP_NTZ type of the table (wall-clock UTC), so
    calendar features and range windows never depend on the session time zone.

    ``spread``: the table's few files are narrow, the wire rows made of them wide; rows are dealt to all cores before.
    """
    ev = read_table(spark, sf_dir, "events")
    n_users = ev.select((F.max("user_id") + 1).alias("n")).scalar()  # scalar subquery
    if spread:
        ev = ev.select("event_id", "user_id", "event_type", "value", "ts", "props").repartition("event_id", "ts")
    eid, uid = F.col("event_id"), F.col("user_id")
    k = F.get_json_object("props", "$.k").cast("bigint")
    return (ev
            .select("event_id", "user_id", "event_type", "value", "ts", k.alias("k"))
            .select(
                "event_id", "user_id", "k",
                _pad("TXN_", eid, 9).alias("txn_id"),
                _pad("USER_", uid, 6).alias("sender_id"),
                _pad("USER_", (eid * 31 + F.col("k")) % n_users, 6).alias("receiver_id"),
                F.col("value").alias("amount"),
                _pick(CURRENCIES, F.col("k") % 3).alias("currency"),
                F.col("event_type").alias("txn_type"),
                _pick(CHANNELS, eid % 3).alias("channel"),
                F.concat(F.lit("DEV_"), (F.col("k") + 1000).cast("string")).alias("device_id"),
                _pick(DEVICE_TYPES, F.floor(eid / 3) % 3).alias("device_type"),
                F.concat_ws(".", F.lit("192.168"), (F.col("k") % 16).cast("string"),
                            (uid % 256).cast("string")).alias("ip_address"),
                ((F.lit(1000) + (eid * 37) % 1300).cast("double") / F.lit(100.0)).alias("lat"),
                ((F.lit(10200) + (eid * 53) % 750).cast("double") / F.lit(100.0)).alias("lon"),
                F.concat(F.lit("MER_"), (F.lit(100) + (eid * 7) % 900).cast("string")).alias("merchant_id"),
                _pick(MERCHANT_CATS, eid % 5).alias("merchant_cat"),
                F.col("ts").alias("event_time"),
                F.timestamp_add("SECOND", ((eid * 13) % 60).cast("int"), F.col("ts")).alias("ingest_time"),
            ))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transaction_source(spark, sf_dir).select(*TRANSACTION_FIELDS)


def blacklist_users(spark: SparkSession, sf_dir: str, spec: FixtureSpec = FixtureSpec()) -> DataFrame:
    """Short-form blacklist (entity_id, entity_type, severity) of receiver users."""
    ev = read_table(spark, sf_dir, "events")
    u = F.col("user_id")
    return (ev.select("user_id")
            .filter(u % spec.blacklist_user_mod == spec.blacklist_user_rem)
            .distinct()
            .select(_pad("USER_", u, 6).alias("entity_id"),
                    F.lit("USER").alias("entity_type"),
                    ((F.floor(u / 10) % 5) + 1).cast("int").alias("severity")))


def _ntz(value) -> Column:
    return ntz_literal(value) if value is not None else F.lit(None).cast("timestamp_ntz")


def blacklist_long(spark: SparkSession, sf_dir: str, spec: FixtureSpec = FixtureSpec()) -> DataFrame:
    """Long-form blacklist with validity intervals for USER, DEVICE and IP entities.

    USER rows never expire; each listed device has two overlapping listings with
    different severities; listed IPs have one listing each.
    """
    src = transaction_source(spark, sf_dir)
    users = blacklist_users(spark, sf_dir, spec).select(
        "entity_id", "entity_type", F.lit("receiver_report").alias("reason"), "severity",
        _ntz("2023-12-01 00:00:00").alias("listed_at"), _ntz(None).alias("expires_at"))
    kk = src.select("k").filter(F.col("k") % 7 == 3).distinct()
    dev_id = F.concat(F.lit("DEV_"), (F.col("k") + 1000).cast("string"))
    start_a = F.timestamp_add("DAY", (F.col("k") % 10).cast("int"), _ntz("2024-01-01 00:00:00"))
    start_b = F.timestamp_add("DAY", (F.col("k") % 6).cast("int"), _ntz("2024-01-05 00:00:00"))
    dev_a = kk.select(dev_id.alias("entity_id"), F.lit("DEVICE").alias("entity_type"),
                      F.lit("chargeback").alias("reason"), ((F.col("k") % 5) + 1).cast("int").alias("severity"),
                      start_a.alias("listed_at"), F.timestamp_add("DAY", F.lit(7), start_a).alias("expires_at"))
    dev_b = kk.select(dev_id.alias("entity_id"), F.lit("DEVICE").alias("entity_type"),
                      F.lit("device_farm").alias("reason"), (((F.col("k") + 2) % 5) + 1).cast("int").alias("severity"),
                      start_b.alias("listed_at"), F.timestamp_add("DAY", F.lit(10), start_b).alias("expires_at"))
    octet = F.col("u4")
    start_ip = F.timestamp_add("DAY", (octet % 7).cast("int"), _ntz("2024-01-08 00:00:00"))
    ips = (src.filter(F.col("k") % 16 == 5)
           .select((F.col("user_id") % 256).alias("u4")).distinct()
           .select(F.concat(F.lit("192.168.5."), octet.cast("string")).alias("entity_id"),
                   F.lit("IP").alias("entity_type"), F.lit("proxy").alias("reason"),
                   ((octet % 5) + 1).cast("int").alias("severity"),
                   start_ip.alias("listed_at"), F.timestamp_add("DAY", F.lit(6), start_ip).alias("expires_at")))
    return users.unionByName(dev_a).unionByName(dev_b).unionByName(ips)


def history(txn: DataFrame, spec: FixtureSpec = FixtureSpec()) -> DataFrame:
    return txn.filter(F.col("event_time") < _ntz(spec.history_before))


def baseline(spark: SparkSession, sf_dir: str, spec: FixtureSpec = FixtureSpec()) -> DataFrame:
    """Per-user amount baseline from history; some users are left without one."""
    src = transaction_source(spark, sf_dir)
    hist = history(src, spec).filter(F.col("user_id") % spec.baseline_skip_mod != spec.baseline_skip_rem)
    return build_baseline(hist).select("user_id", "avg_amount", "stddev_amount")


def known_devices(spark: SparkSession, sf_dir: str, spec: FixtureSpec = FixtureSpec()) -> DataFrame:
    src = transaction_source(spark, sf_dir)
    return build_known_devices(history(src, spec)).select("user_id", "device_id")
