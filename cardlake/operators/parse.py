"""Decode raw JSON payloads into payment rows and split valid / invalid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlake.functions.columns import event_time, utc_day
from cardlake.schemas import CORRUPT_COLUMN, PAYMENT_WITH_CORRUPT, RAW_FIELDS

# Error reasons of the dead-letter stream (fixed values).
EMPTY_PAYLOAD = "EMPTY_PAYLOAD"
INVALID_JSON = "INVALID_JSON"
MISSING_ID = "MISSING_ID"
INVALID_EVENT_TS = "INVALID_EVENT_TS"
MISSING_AMOUNT = "MISSING_AMOUNT"
FRAUD_DETECTED = "FRAUD_DETECTED"
LATE_EVENT = "LATE_EVENT"
FUTURE_EVENT = "FUTURE_EVENT"


def _now(as_of) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def tag_payloads(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Parse every payload once; add ``_error`` (null for a good row).

    A payload is invalid when it is empty, not JSON of the payment schema
    (corrupt-record column set: truncated text, arrays, wrong-typed fields),
    has no transaction id, or has an event time that does not parse.
    """
    raw = F.col(value_col)
    if isinstance(lines.schema[value_col].dataType, T.BinaryType):
        raw = raw.cast("string")
    p = F.from_json(F.col("raw_value"), PAYMENT_WITH_CORRUPT,
                    {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN})
    # Parse once per row: behind the generator, later field accesses read the
    # struct instead of being rewritten into one from_json per field.
    parsed = (lines.select(raw.alias("raw_value"))
                   .select("raw_value", F.inline(F.array(F.struct(p.alias("p"))))))
    ts = event_time("p.ts_event")
    error = (F.when(F.col("raw_value").isNull() | (F.trim("raw_value") == ""), F.lit(EMPTY_PAYLOAD))
              .when(F.col("p").isNull() | F.col(f"p.{CORRUPT_COLUMN}").isNotNull(), F.lit(INVALID_JSON))
              .when(F.col("p.transaction_id").isNull(), F.lit(MISSING_ID))
              .when(ts.isNull(), F.lit(INVALID_EVENT_TS)))
    return parsed.select("raw_value", *[F.col(f"p.{c}").alias(c) for c in RAW_FIELDS],
                         ts.alias("event_ts"), error.alias("_error"))


def parse_payments(lines: DataFrame, value_col: str = "value",
                   as_of=None) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) from a frame with a JSON ``value`` column.

    valid: raw 10 columns + event_ts + date.  invalid: error_reason,
    dlq_ts, the raw payload (kept for replay) and whatever fields parsed.
    Works on batch and streaming frames alike.
    """
    return split_payloads(tag_payloads(lines, value_col), as_of)


def split_payloads(tagged: DataFrame, as_of=None) -> tuple[DataFrame, DataFrame]:
    """``parse_payments`` of payloads that ``tag_payloads`` has parsed."""
    valid = (tagged.filter(F.col("_error").isNull())
             .select(*RAW_FIELDS, "event_ts", utc_day("event_ts").alias("date")))
    invalid = (tagged.filter(F.col("_error").isNotNull())
               .select(F.col("_error").alias("error_reason"), _now(as_of).alias("dlq_ts"),
                       "raw_value", *RAW_FIELDS))
    return valid, invalid
