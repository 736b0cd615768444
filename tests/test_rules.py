from cardlake.operators import rules
from tests.helpers import by_id, payment, payments_df


def test_thresholds_reasons_and_nulls(spark):
    df = payments_df(spark, [
        payment("a", 10000.00), payment("b", 10000.01), payment("c", 20000, "M1001"),
        payment("d", 5, "M1003"), payment("e", None, "M1001"), payment("f", None, "M1003"),
    ])
    got = by_id(rules.flag_stateless(df), "rule_high_amount", "rule_blacklist", "is_fraud", "fraud_reason")
    assert got["a"] == (False, False, False, "")
    assert got["b"] == (True, False, True, "HIGH_AMOUNT")
    assert got["c"] == (True, True, True, "HIGH_AMOUNT,BLACKLISTED_MERCHANT")
    assert got["d"] == (False, False, False, "")
    assert got["e"] == (None, True, True, "BLACKLISTED_MERCHANT")
    assert got["f"] == (None, False, None, "")


def test_blacklist_table_with_repeats_does_not_multiply_rows(spark):
    df = payments_df(spark, [payment("a", 1, "M1001"), payment("b", 1, "M1003"), payment("c", 1, None)])
    listed = spark.createDataFrame([("M1001",), ("M1001",), (None,)], "merchant_id string")
    out = rules.flag_blacklist(df, listed)
    assert out.count() == 3
    assert by_id(out, "rule_blacklist") == {"a": (True,), "b": (False,), "c": (False,)}
    # literal list and table give the same flags
    assert by_id(rules.flag_blacklist(df, ["M1001", "M1001"]), "rule_blacklist") == by_id(out, "rule_blacklist")


def test_route_keeps_every_row(spark):
    df = rules.flag_stateless(payments_df(spark, [
        payment("a", 20000), payment("b", 5), payment("c", None)]))
    clean, flagged, undecided = rules.route(df)
    assert [r.transaction_id for r in clean.collect()] == ["b"]
    assert [r.transaction_id for r in flagged.collect()] == ["a"]
    assert [r.transaction_id for r in undecided.collect()] == ["c"]


def test_blacklist_table_join_keeps_null_merchants(spark):
    df = payments_df(spark, [payment(f"n{i}", 1, None) for i in range(50)] + [payment("a", 1, "M1001")])
    listed = spark.createDataFrame([("M1001",)], "merchant_id string")
    out = rules.flag_blacklist(df, listed)
    assert out.count() == 51
    assert out.filter("rule_blacklist").count() == 1
    assert set(out.columns) == set(df.columns) | {"rule_blacklist"}
