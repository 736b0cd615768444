"""Mart rewrites (aggregate, then scale by dimension rows) vs the SQL as written."""

import datetime as dt
import random
from decimal import Decimal

import pytest

from pyspark.sql import functions as F

from cardlake.operators import models
from cardlake.schemas import MONEY

# Brute force: every fact row paired with each dimension row of its merchant
# (the repetition the models produce as written), then plain aggregates.
PAIRS = "(select x.*, y.channel as dim_channel from f x, d y where y.merchant_id = x.merchant_id)"

SQL = {
    "settlement": f"""
        select date, merchant_id, currency, cast(money as decimal(38,2)) total_amount,
               n transaction_count, cast(round(money * 0.02, 2) as decimal(38,2)) fees,
               cast(round(money - round(money * 0.02, 2), 2) as decimal(38,2)) total_settlement
        from (select date, merchant_id, currency, sum(amount) money, count(distinct transaction_id) n
              from {PAIRS} where not is_fraud and auth_result = 'APPROVED'
              group by date, merchant_id, currency)""",
    "fraud_settlement": f"""
        select date, merchant_id, cast(sum(amount) as decimal(38,2)) total_amount,
               count(distinct transaction_id) transaction_count,
               count(*) filter (where is_fraud) fraud_count,
               cast(coalesce(sum(amount) filter (where is_fraud), 0) as decimal(38,2)) fraud_amount
        from {PAIRS} group by all""",
    "fraud_rate": f"""
        select date, merchant_id, total total_transactions, bad fraud_transactions,
               cast(round(bad * 100.0 / total, 2) as double) fraud_rate_pct
        from (select date, merchant_id, count(*) total, count(*) filter (where is_fraud) bad
              from {PAIRS} group by all)""",
    "channel": f"""
        select date, dim_channel channel, count(distinct transaction_id) transaction_count,
               cast(sum(amount) as decimal(38,2)) total_amount, count(*) filter (where is_fraud) fraud_count
        from {PAIRS} group by all""",
    "alerts": f"""
        select date, transaction_id, merchant_id, amount, currency, is_fraud, fraud_reason,
               rule_high_amount, rule_blacklist
        from {PAIRS} where is_fraud""",
    "currency": """
        select date, currency, currency_code, cast(sum(amount) as decimal(38,2)) total_amount,
               count(distinct transaction_id) transaction_count
        from (select x.*, c.currency_code from f x, c where c.currency_code = x.currency) group by all""",
}


def _rows(seed, n=600):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        out.append((
            rnd.choice([f"T{rnd.randrange(n // 2)}", f"T{i}", None]),        # repeated / null ids
            rnd.choice(["M1", "M2", "M3", "M4", None]),
            rnd.choice([None, Decimal(rnd.randrange(0, 100000)) / 100]),
            rnd.choice(["USD", "EUR", None]),
            rnd.choice(["APPROVED", "DECLINED", None]),
            rnd.choice([True, False, None]),
            rnd.choice(["UK", "USA", None]), rnd.choice(["POS", "ECOM", None]), rnd.choice(["5411", "5999"]),
            dt.date(2024, 1, 1 + rnd.randrange(3)),
        ))
    return out


@pytest.mark.parametrize("seed", [11, 12])
def test_marts_equal_sql_as_written(spark, seed):
    schema = ("transaction_id string, merchant_id string, amount decimal(18,2), currency string, "
              "auth_result string, is_fraud boolean, location string, channel string, mcc string, date date")
    stg = spark.createDataFrame(_rows(seed), schema) \
        .withColumn("fraud_reason", F.lit("")) \
        .withColumn("rule_high_amount", F.lit(False)) \
        .withColumn("rule_blacklist", F.lit(False))
    assert dict(stg.dtypes)["amount"] == MONEY.simpleString()
    d = models.dim_merchants(stg)
    c = models.dim_currency(stg)
    stg.createOrReplaceTempView("f")
    d.createOrReplaceTempView("d")
    c.createOrReplaceTempView("c")
    got = {
        "settlement": models.mart_settlement_daily(stg, d),
        "fraud_settlement": models.mart_fraud_settlement_daily(stg, d),
        "fraud_rate": models.mart_fraud_rate(stg, d),
        "channel": models.mart_channel_performance(stg, d),
        "alerts": models.mart_fraud_alerts(stg, d),
        "currency": models.mart_currency_volume(stg, c),
    }
    for name, df in got.items():
        want = spark.sql(SQL[name])
        cols = sorted(df.columns)
        assert cols == sorted(want.columns), name
        a, b = df.select(*cols), want.select(*cols)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
