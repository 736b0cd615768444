"""Dead-letter envelopes: flagged rows and invalid rows as (key, value JSON)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.functions.columns import utc_day
from cardlake.operators.parse import FRAUD_DETECTED, MISSING_AMOUNT, tag_payloads
from cardlake.schemas import RAW_FIELDS


def _now(as_of):
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def to_value(df: DataFrame) -> DataFrame:
    """Whole row as one JSON ``value`` (value-only dead letter)."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))


def undecided_as_invalid(undecided: DataFrame, as_of=None) -> DataFrame:
    """Rows whose decision is null (e.g. missing amount) for the dead letter."""
    return (undecided.withColumn("error_reason", F.lit(MISSING_AMOUNT))
                     .withColumn("dlq_ts", _now(as_of)))


def dead_letter(flagged: DataFrame, invalid: DataFrame | None = None, as_of=None,
                key: str = "card_hash") -> DataFrame:
    """(key, value): flagged rows (reason FRAUD_DETECTED) plus invalid rows.

    Union by name with missing columns as null; the key is the card when
    known, so one card's letters stay in order within a topic partition.
    """
    out = (flagged.withColumn("error_reason", F.lit(FRAUD_DETECTED))
                  .withColumn("dlq_ts", _now(as_of)))
    if invalid is not None:
        out = out.unionByName(invalid, allowMissingColumns=True)
    k = F.col(key).cast("string") if key in out.columns else F.lit(None).cast("string")
    return out.select(k.alias("key"), F.to_json(F.struct(*[F.col(c) for c in out.columns])).alias("value"))


def dead_letters(lines: DataFrame, blacklist=None, as_of=None, key: str = "card_hash",
                 value_col: str = "value") -> DataFrame:
    """All dead letters of a payload source in ONE pass: (key, value JSON).

    Same letters as ``dead_letter(flagged, invalid + undecided)`` built from
    ``parse_payments`` and ``route``, but the payloads are parsed once and
    each row gets its reason from one expression (payloads that do not parse,
    then FRAUD_DETECTED, then MISSING_AMOUNT for a null decision); a union
    of three branches of the same source would read and parse it three times
    (in a stream: every micro-batch three times).  Fields that do not belong
    to a letter's kind are null, so its JSON matches the union form.
    """
    return letters_of(decide_payloads(lines, blacklist, value_col), as_of, key)


def decide_payloads(lines: DataFrame, blacklist=None, value_col: str = "value") -> DataFrame:
    """All payloads parsed and tagged with the two stateless rules; ``_error`` is
    set for those that do not parse."""
    from cardlake.operators.rules import DEFAULT_BLACKLIST, flag_stateless
    tagged = tag_payloads(lines, value_col).withColumn("date", utc_day("event_ts"))
    return flag_stateless(tagged, DEFAULT_BLACKLIST if blacklist is None else blacklist)


def letters_of(flagged: DataFrame, as_of=None, key: str = "card_hash") -> DataFrame:
    """``dead_letters`` of payloads that ``decide_payloads`` has tagged."""
    bad = F.col("_error").isNotNull()
    reason = (F.when(bad, F.col("_error"))
               .when(F.col("is_fraud"), F.lit(FRAUD_DETECTED))
               .when(F.col("is_fraud").isNull(), F.lit(MISSING_AMOUNT)))
    decided = [c for c in flagged.columns if c not in RAW_FIELDS + ["raw_value", "_error"]]
    fields = ([F.col(c) for c in RAW_FIELDS]
              + [F.when(~bad, F.col(c)).alias(c) for c in decided]
              + [F.col("_reason").alias("error_reason"), _now(as_of).alias("dlq_ts"),
                 F.when(bad, F.col("raw_value")).alias("raw_value")])
    letters = flagged.withColumn("_reason", reason).filter(F.col("_reason").isNotNull())
    return letters.select(F.col(key).cast("string").alias("key"),
                          F.to_json(F.struct(*fields)).alias("value"))
