"""Declared schemas of every layer (raw JSON, bronze, silver, warehouse, state).

Declared instead of inferred: a stream must not depend on what happens to be
on disk, and a bad file must not change the table's schema.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, B = T.StringType(), T.DoubleType(), T.BooleanType()

RAW_FIELDS = ["transaction_id", "ts_event", "card_hash", "merchant_id", "amount",
              "currency", "mcc", "channel", "auth_result", "location"]

PAYMENT = T.StructType([
    T.StructField("transaction_id", S), T.StructField("ts_event", S),
    T.StructField("card_hash", S), T.StructField("merchant_id", S),
    T.StructField("amount", D), T.StructField("currency", S),
    T.StructField("mcc", S), T.StructField("channel", S),
    T.StructField("auth_result", S), T.StructField("location", S),
])

CORRUPT_COLUMN = "_corrupt_record"

PAYMENT_WITH_CORRUPT = T.StructType(
    PAYMENT.fields + [T.StructField(CORRUPT_COLUMN, S)])

# Parsed payment: raw columns + event time and its UTC day.
PARSED = T.StructType(PAYMENT.fields + [
    T.StructField("event_ts", T.TimestampType()),
    T.StructField("date", T.DateType()),
])

STATELESS_FLAGS = ["rule_high_amount", "rule_blacklist"]
CARD_FLAGS = ["rule_velocity", "rule_cross_border", "rule_decline_rate"]

# Bronze (16): merchant_id first, as produced by the join on merchant_id.
BRONZE_COLUMNS = ["merchant_id", "transaction_id", "ts_event", "card_hash", "amount",
                  "currency", "mcc", "channel", "auth_result", "location",
                  "event_ts", "date", "rule_high_amount", "rule_blacklist",
                  "is_fraud", "fraud_reason"]

_BRONZE_TYPES = {
    "amount": D, "event_ts": T.TimestampType(), "date": T.DateType(),
    "rule_high_amount": B, "rule_blacklist": B, "is_fraud": B,
}

BRONZE = T.StructType([T.StructField(c, _BRONZE_TYPES.get(c, S)) for c in BRONZE_COLUMNS])

SILVER_COLUMNS = BRONZE_COLUMNS + ["processed_at"]
SILVER = T.StructType(BRONZE.fields + [T.StructField("processed_at", T.TimestampType())])

# Warehouse `transactions` (17), fixed order, money as decimal(18,2).
MONEY = T.DecimalType(18, 2)
WAREHOUSE_COLUMNS = ["transaction_id", "ts_event", "card_hash", "merchant_id", "amount",
                     "currency", "mcc", "channel", "auth_result", "location",
                     "event_ts", "rule_high_amount", "rule_blacklist", "is_fraud",
                     "fraud_reason", "processed_at", "date"]

# Card-rule output: raw + event_ts, event_date + five flags.
CARD_RULE_COLUMNS = RAW_FIELDS + ["event_ts", "event_date"] + STATELESS_FLAGS + CARD_FLAGS

CARD_STATE = T.StructType([
    T.StructField("events", T.ArrayType(T.StructType([
        T.StructField("ts_us", T.LongType()),
        T.StructField("transaction_id", S),
        T.StructField("location", S),
        T.StructField("auth_result", S),
    ]))),
])
