from decimal import Decimal

from cardlake.operators import layers, models, rules
from tests.helpers import payment, payments_df


def _stg(spark, rows):
    b = rules.flag_stateless(payments_df(spark, rows))
    return models.stg_transactions(layers.to_warehouse(layers.with_processed_at(b, "2024-02-01 00:00:00")))


def test_fee_rounding_half_up(spark):
    s = _stg(spark, [payment("a", 0.25, "M1003")])
    f, d = models.fact_transactions(s), models.dim_merchants(s)
    row = models.mart_settlement_daily(f, d).first()
    assert row.total_amount == Decimal("0.25")
    assert row.fees == Decimal("0.01")
    assert row.total_settlement == Decimal("0.24")


def test_fan_out_matches_join_as_written(spark):
    rows = [payment("a", 10, "M1003", location="UK"), payment("b", 20, "M1003", location="USA"),
            payment("c", 30, "M1003", location="India"), payment("d", 40, "M1004")]
    s = _stg(spark, rows)
    f, d = models.fact_transactions(s), models.dim_merchants(s)
    f.createOrReplaceTempView("f_t")
    d.createOrReplaceTempView("d_t")
    written = spark.sql("""select date, merchant_id, sum(amount) s, count(distinct transaction_id) n
                           from (select x.* from f_t x, d_t y where y.merchant_id = x.merchant_id)
                           group by all""")
    want = {r.merchant_id: (r.s, r.n) for r in written.collect()}
    got = {r.merchant_id: (r.total_amount, r.transaction_count)
           for r in models.mart_fraud_settlement_daily(f, d).collect()}
    assert got == want
    assert want["M1003"] == (Decimal("180.00"), 3)          # 3 dim rows x 60
    exact = {r.merchant_id: r.total_amount
             for r in models.mart_fraud_settlement_daily(f, d, one_row_per_merchant=True).collect()}
    assert exact["M1003"] == Decimal("60.00")
    assert models.mart_fraud_alerts(f, d).count() == 0


def test_null_currency_dropped_from_currency_mart(spark):
    s = _stg(spark, [payment("a", 1, currency=None), payment("b", 2, currency="USD")])
    f, c = models.fact_transactions(s), models.dim_currency(s)
    rows = models.mart_currency_volume(f, c).collect()
    assert [(r.currency, r.total_amount) for r in rows] == [("USD", Decimal("2.00"))]
