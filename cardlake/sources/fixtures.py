"""Deterministic payment views derived from the driver's ``events`` table.

Mapping (fixed values of the test fixtures, see FIXTURES.md section B):

* transaction_id = 'TXN' + event_id left-padded to 12 digits
* event_ts = BASE + (micros(ts) - BASE) div scale   (scale 1 or 720)
* ts_event = event_ts as yyyy-MM-ddTHH:mm:ss.SSSSSS+00:00
* card_hash = sha1('card-' + user_id)
* merchant_id = event_id mod 40: 0 -> M1001, 1 -> M2002, 2 -> M9999,
  n -> 'M' + (1000 + n)
* amount = round(value * 100, 2)
* currency = k mod 4: 0 USD, 1 EUR, 2 GBP, 3 INR   (k = $.k of props)
* mcc by event_type: click 5411, view 5812, purchase 5999, signup 4111,
  error 6011
* channel = POS when k is even, else ECOM
* auth_result = DECLINED for error and signup, else APPROVED
* location = India when k >= 98, else USA for even user_id, UK for odd
* dirty rows: amount negated where event_id mod 97 = 0, null where mod 103 = 0,
  id null where mod 101 = 0, a second copy with amount + 1 where mod 50 = 0
* raw lines: JSON of the dirty rows, cut to 20 characters where mod 89 = 0,
  empty where mod 83 = 0

All of it is column expressions over one scan of ``events``: no join, no
shuffle, so the views scale with the table.  The modulo rules only choose
which events get a corrupted copy (negative / missing amount, missing id,
truncated or empty delivery); no event is filtered out, and every delivered
line is parsed whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.functions.columns import utc_day
from cardlake.schemas import RAW_FIELDS

# Fixed values of the fixture mapping.
BASE_MICROS = 1704067200000000  # 2024-01-01 00:00:00 UTC
FAST_SCALE = 720
BLACKLISTED_FIXTURE_MERCHANTS = {0: "M1001", 1: "M2002", 2: "M9999"}
CURRENCY_BY_K_MOD_4 = ["USD", "EUR", "GBP", "INR"]
MCC_BY_EVENT_TYPE = {"click": "5411", "view": "5812", "purchase": "5999",
                     "signup": "4111", "error": "6011"}
DECLINED_EVENT_TYPES = ["error", "signup"]
TS_TEXT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"
DIRTY_NEGATIVE_MOD, DIRTY_NULL_AMOUNT_MOD, DIRTY_NULL_ID_MOD, DIRTY_COPY_MOD = 97, 103, 101, 50
LINE_CUT_MOD, LINE_CUT_CHARS, LINE_EMPTY_MOD = 89, 20, 83


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _case(col: Column, mapping: dict, default: Column | None = None) -> Column:
    out = None
    for key, val in mapping.items():
        out = (F.when(col == F.lit(key), F.lit(val)) if out is None
               else out.when(col == F.lit(key), F.lit(val)))
    return out.otherwise(default) if default is not None else out


def payments_from_events(ev: DataFrame, scale: int = 1,
                         keep_event_id: bool = False) -> DataFrame:
    """Parsed payments (raw 10 columns + event_ts + date) from ``events``."""
    k = F.get_json_object("props", "$.k").cast("int")
    # ts is timestamp_ntz in the files: read its wall time as UTC, whatever
    # the session zone (a plain cast would use the session zone)
    utc_us = "unix_micros(to_timestamp(concat(cast(ts as string), 'Z')))"
    shifted = F.expr(f"{BASE_MICROS} + ({utc_us} - {BASE_MICROS}) div {scale}")
    event_ts = F.timestamp_micros(shifted)
    mod40 = F.col("event_id") % 40
    merchant = _case(mod40, BLACKLISTED_FIXTURE_MERCHANTS,
                     F.concat(F.lit("M"), (mod40 + 1000).cast("string")))
    currency = _case(F.col("k") % 4, dict(enumerate(CURRENCY_BY_K_MOD_4)))
    cols = [
        F.concat(F.lit("TXN"), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("transaction_id"),
        # rendered as UTC wall time whatever the session zone
        F.date_format(F.to_utc_timestamp("event_ts", F.current_timezone()), TS_TEXT_FORMAT).alias("ts_event"),
        F.sha1(F.concat(F.lit("card-"), F.col("user_id").cast("string"))).alias("card_hash"),
        merchant.alias("merchant_id"),
        F.round(F.col("value") * 100, 2).alias("amount"),
        currency.alias("currency"),
        _case(F.col("event_type"), MCC_BY_EVENT_TYPE).alias("mcc"),
        F.when(F.col("k") % 2 == 0, "POS").otherwise("ECOM").alias("channel"),
        F.when(F.col("event_type").isin(DECLINED_EVENT_TYPES), "DECLINED")
         .otherwise("APPROVED").alias("auth_result"),
        F.when(F.col("k") >= 98, "India")
         .when(F.col("user_id") % 2 == 0, "USA").otherwise("UK").alias("location"),
        F.col("event_ts"),
        utc_day("event_ts").alias("date"),
    ]
    if keep_event_id:
        cols.append(F.col("event_id"))
    return (ev.select("event_id", "user_id", "event_type", "value",
                      k.alias("k"), event_ts.alias("event_ts"))
              .select(*cols))


def payments(spark: SparkSession, sf_dir: str, scale: int = 1) -> DataFrame:
    return payments_from_events(events(spark, sf_dir), scale)


def payments_fast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same payments squeezed into one hour, so the per-card rules fire."""
    return payments(spark, sf_dir, FAST_SCALE)


def dirty_from_events(ev: DataFrame, keep_event_id: bool = False) -> DataFrame:
    """payments with negative / null amounts, null ids and repeated rows."""
    p = payments_from_events(ev, 1, keep_event_id=True)
    eid = F.col("event_id")
    amount = (F.when(eid % DIRTY_NULL_AMOUNT_MOD == 0, F.lit(None).cast("double"))
               .when(eid % DIRTY_NEGATIVE_MOD == 0, -F.col("amount"))
               .otherwise(F.col("amount")))
    txn = F.when(eid % DIRTY_NULL_ID_MOD == 0, F.lit(None).cast("string")).otherwise(F.col("transaction_id"))
    # one or two copies per event, without a self-union (one scan)
    copies = F.when(eid % DIRTY_COPY_MOD == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    out = (p.withColumn("amount", amount).withColumn("transaction_id", txn)
             .withColumn("_copy", F.explode(copies))
             .withColumn("amount", F.col("amount") + (F.col("_copy") - 1)).drop("_copy"))
    return out if keep_event_id else out.drop("event_id")


def payments_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty_from_events(events(spark, sf_dir))


def raw_lines_from_events(ev: DataFrame) -> DataFrame:
    """One ``value`` text column: the JSON payload a broker would deliver."""
    d = dirty_from_events(ev, keep_event_id=True)
    js = F.to_json(F.struct(*[F.col(c) for c in RAW_FIELDS]))
    eid = F.col("event_id")
    value = (F.when(eid % LINE_EMPTY_MOD == 0, F.lit(""))
              .when(eid % LINE_CUT_MOD == 0, F.substring(js, 1, LINE_CUT_CHARS))
              .otherwise(js))
    return d.select(value.alias("value"))


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_lines_from_events(events(spark, sf_dir))
