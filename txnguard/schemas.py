"""Hand-written schemas of the transaction payload, reference tables and outputs."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType, IntegerType, StringType, StructField, StructType, TimestampType,
)

# Names, types and order of the payload's fields; the required ones are not nullable.
TRANSACTION_SCHEMA = StructType([
    StructField("txn_id", StringType(), False),
    StructField("sender_id", StringType(), False),
    StructField("receiver_id", StringType(), False),
    StructField("amount", DoubleType(), False),
    StructField("currency", StringType(), True),
    StructField("txn_type", StringType(), True),
    StructField("channel", StringType(), True),
    StructField("device_id", StringType(), True),
    StructField("device_type", StringType(), True),
    StructField("ip_address", StringType(), True),
    StructField("lat", DoubleType(), True),
    StructField("lon", DoubleType(), True),
    StructField("merchant_id", StringType(), True),
    StructField("merchant_cat", StringType(), True),
    StructField("event_time", TimestampType(), False),
    StructField("ingest_time", TimestampType(), True),
])

TRANSACTION_FIELDS = [f.name for f in TRANSACTION_SCHEMA.fields]
REQUIRED_FIELDS = [f.name for f in TRANSACTION_SCHEMA.fields if not f.nullable]

# The reference tables' fields. Any kind of entity may be listed; severities have no set scale.
BLACKLIST_SCHEMA = StructType([
    StructField("entity_id", StringType(), False),
    StructField("entity_type", StringType(), True),
    StructField("reason", StringType(), True),
    StructField("severity", IntegerType(), True),
    StructField("listed_at", TimestampType(), True),
    StructField("expires_at", TimestampType(), True),
])

BASELINE_SCHEMA = StructType([
    StructField("user_id", StringType(), False),
    StructField("avg_amount", DoubleType(), True),
    StructField("stddev_amount", DoubleType(), True),
])

DEVICE_SCHEMA = StructType([
    StructField("user_id", StringType(), False),
    StructField("device_id", StringType(), False),
])

# The columns of an alert, in order.
OUTPUT_COLUMNS = [
    "txn_id", "sender_id", "receiver_id", "amount",
    "txn_type", "channel",
    "bl_receiver_severity", "amount_zscore", "is_new_device",
    "fraud_rule_score", "ml_fraud_score", "final_fraud_score",
    "rule_flags",
]
