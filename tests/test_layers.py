import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from cardlake.operators import layers, rules
from tests.helpers import payment, payments_df


def _bronze(spark, rows):
    return rules.flag_stateless(payments_df(spark, rows))


def test_dedup_pairs_and_order(spark):
    b = _bronze(spark, [payment("a", 5, sec=0), payment("a", 5, sec=0), payment("a", 6, sec=1)])
    out = layers.to_silver(b, processed_at="2024-02-01 00:00:00")
    assert out.count() == 2   # same id, other time: both kept


def test_negative_first_copy_removes_later_good_copy(spark):
    rows = [payment("a", -1, sec=0), payment("a", 5, sec=0)]
    b = _bronze(spark, rows).withColumn("seq", F.monotonically_increasing_id())
    b = b.withColumn("seq", F.when(F.col("amount") < 0, 0).otherwise(1))
    out = layers.to_silver(b, order_by=["seq"], processed_at="2024-02-01 00:00:00")
    assert out.count() == 0


def test_null_keys_compare_equal_in_dedup(spark):
    b = _bronze(spark, [payment(None, 5, sec=0), payment(None, 5, sec=0), payment(None, 5, sec=3)])
    assert layers.dedup_first(b).count() == 2


def test_warehouse_projection(spark):
    b = layers.to_silver(_bronze(spark, [payment("a", 12.345), payment(None, 1)]),
                         processed_at="2024-02-01 00:00:00")
    w = layers.to_warehouse(b)
    assert w.columns[:5] == ["transaction_id", "ts_event", "card_hash", "merchant_id", "amount"]
    assert dict(w.dtypes)["amount"] == "decimal(18,2)"
    rows = w.collect()
    assert len(rows) == 1 and rows[0].amount in (Decimal("12.35"), Decimal("12.34"))
    assert rows[0].processed_at == dt.datetime(2024, 2, 1)
