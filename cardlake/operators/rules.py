"""Stateless fraud rules (high amount, blacklist), flag combination, routing."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.functions.columns import any_true, reason_list
from cardlake.schemas import BRONZE_COLUMNS

# Fixed values of the rules (defaults; every one is a parameter).
HIGH_AMOUNT_LIMIT = 10000.0
DEFAULT_BLACKLIST = ("M1001", "M2002", "M9999")
STATELESS_RULES = [("rule_high_amount", "HIGH_AMOUNT"),
                   ("rule_blacklist", "BLACKLISTED_MERCHANT")]
ALL_RULES = STATELESS_RULES + [("rule_velocity", "VELOCITY"),
                               ("rule_cross_border", "CROSS_BORDER"),
                               ("rule_decline_rate", "DECLINE_RATE")]

def blacklist_table(spark: SparkSession, merchants: Iterable[str] = DEFAULT_BLACKLIST) -> DataFrame:
    """Literal one-column table of listed merchants."""
    return spark.createDataFrame([(m,) for m in merchants], "merchant_id string")


def flag_high_amount(df: DataFrame, limit: float = HIGH_AMOUNT_LIMIT,
                     out: str = "rule_high_amount") -> DataFrame:
    """amount strictly over ``limit``; a null amount gives a null flag."""
    return df.withColumn(out, F.col("amount") > F.lit(limit))


def flag_blacklist(df: DataFrame, blacklist: DataFrame | Sequence[str] = DEFAULT_BLACKLIST,
                   out: str = "rule_blacklist") -> DataFrame:
    """True when the merchant is listed, else false (never null).

    A literal list becomes an ``IN`` set inside the scan's codegen stage: no
    join at all.  A table is de-duplicated first (a repeated entry must not
    multiply rows) and joined without a hint: Spark broadcasts it where its
    measured size allows, and shuffles both sides otherwise.  A null merchant
    matches nothing, so null keys are spread over many values that can't match
    either.  Works for streaming ``df`` (stream-static join).
    """
    if not isinstance(blacklist, DataFrame):
        members = sorted({m for m in blacklist if m is not None})
        flag = F.coalesce(F.col("merchant_id").isin(members), F.lit(False))
        return df.withColumn(out, flag)
    listed = (blacklist.select(F.col("merchant_id").alias("_bl_merchant"))
              .where(F.col("_bl_merchant").isNotNull()).distinct().withColumn("_listed", F.lit(True)))
    spread = F.when(F.col("merchant_id").isNull(),
                    F.concat(F.lit("\u0000"), (F.abs(F.xxhash64(*df.columns)) % 4096).cast("string"))
                    ).otherwise(F.col("merchant_id"))
    keyed = df.withColumn("_bl_key", spread)
    joined = keyed.join(listed, keyed["_bl_key"] == listed["_bl_merchant"], "left").drop("_bl_key")
    return (joined.withColumn(out, F.coalesce(F.col("_listed"), F.lit(False)))
                  .drop("_listed", "_bl_merchant"))


def combine_flags(df: DataFrame, rules: Sequence[tuple[str, str]] = STATELESS_RULES) -> DataFrame:
    """is_fraud = OR of the flags (three-valued); fraud_reason = comma list."""
    return (df.withColumn("is_fraud", any_true([f for f, _ in rules]))
              .withColumn("fraud_reason", reason_list(rules)))


def flag_stateless(df: DataFrame, blacklist: DataFrame | Sequence[str] = DEFAULT_BLACKLIST,
                   limit: float = HIGH_AMOUNT_LIMIT) -> DataFrame:
    """Parsed payments -> bronze layout (16 columns): two rules + decision."""
    out = combine_flags(flag_blacklist(flag_high_amount(df, limit), blacklist))
    if all(c in out.columns for c in BRONZE_COLUMNS):
        out = out.select(*BRONZE_COLUMNS, *[c for c in out.columns if c not in BRONZE_COLUMNS])
    return out


def route(df: DataFrame, flag: str = "is_fraud") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(clean, flagged, undecided): false / true / null decision.

    The reference's two filters lose rows whose decision is null; they are
    returned as a third frame so that no row disappears.
    """
    f = F.col(flag)
    return df.filter(~f), df.filter(f), df.filter(f.isNull())
