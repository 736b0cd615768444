"""Warehouse models: staging view, facts, dimensions and marts.

Each model is a function of the models it references, so one Catalyst plan
covers the chain and column pruning reaches the scan.

Marts join facts to ``dim_merchants`` on merchant_id.  That dimension holds
one row per (merchant, location, mcc, channel), so the join as written
repeats each fact row once per dimension row of its merchant: sums and row
counts grow by that factor, distinct counts and ratios do not.  The default
reproduces those numbers exactly, but *without* building the repeated rows:
facts are aggregated first (partial aggregation before the shuffle), then
joined to a per-merchant row count (one row per merchant) and scaled.  With
``one_row_per_merchant=True`` the factor is 1 (true sums).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STG_COLUMNS = ["merchant_id", "transaction_id", "ts_event", "card_hash", "amount", "currency",
               "mcc", "channel", "auth_result", "location", "event_ts", "rule_high_amount",
               "rule_blacklist", "is_fraud", "fraud_reason", "processed_at", "date"]
FACT_COLUMNS = ["transaction_id", "merchant_id", "amount", "currency", "event_ts", "card_hash",
                "auth_result", "is_fraud", "fraud_reason", "rule_high_amount", "rule_blacklist",
                "processed_at", "date"]
SIGNAL_COLUMNS = ["date", "transaction_id", "merchant_id", "is_fraud", "fraud_reason",
                  "rule_high_amount", "rule_blacklist"]
ALERT_COLUMNS = ["date", "transaction_id", "merchant_id", "amount", "currency", "is_fraud",
                 "fraud_reason", "rule_high_amount", "rule_blacklist"]

# Output types: money decimal(38,2), counts bigint, percentages double.
MONEY_OUT = "decimal(38,2)"
FEE_RATE = "0.02"


# ---- staging, facts, dimensions -------------------------------------------

def stg_transactions(transactions: DataFrame) -> DataFrame:
    return transactions.select(*STG_COLUMNS)


def fact_transactions(stg: DataFrame) -> DataFrame:
    return stg.select(*FACT_COLUMNS)


def fact_fraud_signals(stg: DataFrame) -> DataFrame:
    """All rows (no is_fraud filter): the fraud-rate mart needs the totals."""
    return stg.select(*SIGNAL_COLUMNS)


def dim_merchants(stg: DataFrame) -> DataFrame:
    return stg.select("merchant_id", "location", "mcc", "channel").distinct()


def dim_currency(stg: DataFrame) -> DataFrame:
    return stg.select(F.col("currency").alias("currency_code")).distinct()


def dim_auth_results(stg: DataFrame) -> DataFrame:
    return stg.select("auth_result").distinct()


# ---- helpers -----------------------------------------------------------------

def _flag_count(flag: str = "is_fraud") -> Column:
    """sum(case when flag then 1 else 0 end): null counts as 0."""
    return F.sum(F.when(F.col(flag), F.lit(1)).otherwise(F.lit(0))).cast("long")


def merchant_multiplicity(dim: DataFrame, one_row_per_merchant: bool = False,
                          by: tuple[str, ...] = ()) -> DataFrame:
    """Rows of ``dim`` per merchant (and ``by`` columns) as ``_k``.

    A null merchant never matches an equi-join, so it is dropped here.  The
    result has one row per merchant: bounded by the merchant count, not by
    the number of transactions.
    """
    d = dim.where(F.col("merchant_id").isNotNull())
    if one_row_per_merchant:
        return d.select("merchant_id", *by).distinct().withColumn("_k", F.lit(1).cast("long"))
    return d.groupBy("merchant_id", *by).agg(F.count(F.lit(1)).alias("_k"))


def _money(c: Column) -> Column:
    return c.cast(MONEY_OUT)


# ---- marts -------------------------------------------------------------------

def settlement_base(fact: DataFrame) -> DataFrame:
    """Unscaled per (date, merchant, currency) sums of approved, non-fraud rows."""
    return (fact.filter((F.col("is_fraud") == F.lit(False)) & (F.col("auth_result") == "APPROVED"))
                .groupBy("date", "merchant_id", "currency")
                .agg(F.sum("amount").alias("_sum"),
                     F.countDistinct("transaction_id").alias("transaction_count")))


def settlement_from_base(base: DataFrame, k: DataFrame, fee_rate: str = FEE_RATE) -> DataFrame:
    total = _money(F.col("_sum") * F.col("_k"))
    out = base.join(k, "merchant_id").select(
        "date", "merchant_id", "currency", total.alias("total_amount"),
        F.col("transaction_count").cast("long").alias("transaction_count"))
    fees = _money(F.round(F.col("total_amount") * F.lit(Decimal(fee_rate)), 2))
    return (out.withColumn("fees", fees)
               .withColumn("total_settlement", _money(F.round(F.col("total_amount") - F.col("fees"), 2))))


def mart_settlement_daily(fact: DataFrame, dim: DataFrame, fee_rate: str = FEE_RATE,
                          one_row_per_merchant: bool = False) -> DataFrame:
    """Per (date, merchant, currency): approved, non-fraud money and fees."""
    return settlement_from_base(settlement_base(fact), merchant_multiplicity(dim, one_row_per_merchant),
                                fee_rate)


def merchant_day_base(fact: DataFrame) -> DataFrame:
    """Unscaled per (date, merchant) money, distinct ids, rows, fraud rows and money."""
    fraud_amount = F.sum(F.when(F.col("is_fraud"), F.col("amount")).otherwise(F.lit(0)))
    return (fact.groupBy("date", "merchant_id")
                .agg(F.sum("amount").alias("_sum"),
                     F.countDistinct("transaction_id").alias("transaction_count"),
                     F.count(F.lit(1)).alias("_n"),
                     _flag_count().alias("_fc"), fraud_amount.alias("_fa")))


def fraud_settlement_from_base(base: DataFrame, k: DataFrame) -> DataFrame:
    return base.join(k, "merchant_id").select(
        "date", "merchant_id",
        _money(F.col("_sum") * F.col("_k")).alias("total_amount"),
        F.col("transaction_count").cast("long").alias("transaction_count"),
        (F.col("_fc") * F.col("_k")).cast("long").alias("fraud_count"),
        _money(F.col("_fa") * F.col("_k")).alias("fraud_amount"))


def mart_fraud_settlement_daily(fact: DataFrame, dim: DataFrame,
                                one_row_per_merchant: bool = False) -> DataFrame:
    """Per (date, merchant): money, distinct transactions, fraud count and money."""
    return fraud_settlement_from_base(merchant_day_base(fact),
                                      merchant_multiplicity(dim, one_row_per_merchant))


def fraud_rate_pct(fraud: Column, total: Column) -> Column:
    """round(100.0 * fraud / total, 2) in decimal (half up), as double."""
    return F.round(F.lit(Decimal("100.0")) * fraud / total, 2).cast("double")


def fraud_rate_from_base(base: DataFrame, k: DataFrame) -> DataFrame:
    out = base.join(k, "merchant_id").select(
        "date", "merchant_id",
        (F.col("_n") * F.col("_k")).cast("long").alias("total_transactions"),
        (F.col("_fc") * F.col("_k")).cast("long").alias("fraud_transactions"))
    return out.withColumn("fraud_rate_pct",
                          fraud_rate_pct(F.col("fraud_transactions"), F.col("total_transactions")))


def mart_fraud_rate(signals: DataFrame, dim: DataFrame,
                    one_row_per_merchant: bool = False) -> DataFrame:
    """Per (date, merchant): rows, fraud rows, fraud percentage."""
    base = (signals.groupBy("date", "merchant_id")
                   .agg(F.count(F.lit(1)).alias("_n"), _flag_count().alias("_fc")))
    return fraud_rate_from_base(base, merchant_multiplicity(dim, one_row_per_merchant))


def currency_base(fact: DataFrame) -> DataFrame:
    """Unscaled per (date, currency) money and distinct ids."""
    return (fact.groupBy("date", "currency")
                .agg(F.sum("amount").alias("_sum"),
                     F.countDistinct("transaction_id").alias("transaction_count")))


def currency_multiplicity(currencies: DataFrame) -> DataFrame:
    return (currencies.where(F.col("currency_code").isNotNull())
            .groupBy("currency_code").agg(F.count(F.lit(1)).alias("_k")))


def currency_from_base(base: DataFrame, k: DataFrame) -> DataFrame:
    j = base.join(k, base["currency"] == k["currency_code"])
    return j.select("date", "currency", "currency_code",
                    _money(F.col("_sum") * F.col("_k")).alias("total_amount"),
                    F.col("transaction_count").cast("long").alias("transaction_count"))


def mart_currency_volume(fact: DataFrame, currencies: DataFrame) -> DataFrame:
    """Per (date, currency): money and distinct transactions of known currencies.

    Aggregated first, then joined to the (tiny) currency dimension; a null
    currency has no match and drops out, as in the equi-join.
    """
    return currency_from_base(currency_base(fact), currency_multiplicity(currencies))


def mart_channel_performance(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Per (date, dimension channel), as written.

    A merchant with rows in several channels counts its transactions in each
    of them.  Sums come from one row per (date, merchant), scaled by the
    dimension row count; only the distinct ids meet the channels row by row.
    """
    pairs = channel_pairs(dim)
    return channel_from_bases(merchant_day_base(fact), channel_ids_base(fact, pairs), pairs)


def channel_pairs(dim: DataFrame) -> DataFrame:
    """(merchant, channel) per dimension row count: the channel mart's factor."""
    return merchant_multiplicity(dim, by=("channel",))


def channel_ids_base(fact: DataFrame, pairs: DataFrame) -> DataFrame:
    """Per (date, dimension channel): distinct ids over the merchants in that channel."""
    ids = fact.select("date", "merchant_id", "transaction_id").distinct()
    j = ids.join(pairs.select("merchant_id", "channel"), "merchant_id")
    return (j.groupBy("date", "channel")
             .agg(F.countDistinct("transaction_id").cast("long").alias("transaction_count")))


def channel_from_bases(day_base: DataFrame, ids: DataFrame, pairs: DataFrame) -> DataFrame:
    """Channel mart from per-(date, merchant) sums and per-(date, channel) distinct ids."""
    sums = (day_base.join(pairs, "merchant_id").groupBy("date", "channel")
                    .agg(_money(F.sum(F.col("_sum") * F.col("_k"))).alias("total_amount"),
                         F.sum(F.col("_fc") * F.col("_k")).cast("long").alias("fraud_count")))
    # a null date or channel is a group of its own
    same = ids["date"].eqNullSafe(sums["date"]) & ids["channel"].eqNullSafe(sums["channel"])
    return ids.join(sums, same).select(
        ids["date"], ids["channel"], "transaction_count", "total_amount", "fraud_count")


def mart_channel_performance_exact(stg: DataFrame, dim: DataFrame) -> DataFrame:
    """Per (date, the transaction's own channel): true sums, no repetition."""
    merchants = dim.where(F.col("merchant_id").isNotNull()).select("merchant_id").distinct()
    j = stg.join(merchants, "merchant_id", "left_semi")
    return (j.groupBy("date", "channel")
             .agg(F.countDistinct("transaction_id").cast("long").alias("transaction_count"),
                  _money(F.sum("amount")).alias("total_amount"),
                  _flag_count().alias("fraud_count")))


def mart_fraud_alerts(fact: DataFrame, dim: DataFrame,
                      one_row_per_merchant: bool = False) -> DataFrame:
    """Fraud rows with 9 columns; as written, once per dimension row of the merchant.

    Joined to the per-merchant count and repeated with ``explode`` after the
    join, so the shuffle carries one row per alert, not per copy.
    """
    k = merchant_multiplicity(dim, one_row_per_merchant)
    j = fact.filter(F.col("is_fraud") == F.lit(True)).join(k, "merchant_id")
    if not one_row_per_merchant:
        j = j.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_k"))))
    return j.select(*ALERT_COLUMNS)
