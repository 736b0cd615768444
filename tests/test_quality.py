from cardlake.operators import layers, models, quality, rules
from tests.helpers import payment, payments_df


def _stg(spark, rows):
    b = rules.flag_stateless(payments_df(spark, rows))
    return models.stg_transactions(layers.to_warehouse(layers.with_processed_at(b), require_id=False))


def test_checks(spark):
    s = _stg(spark, [payment("a", 1), payment("a", -2), payment(None, None, currency=None)])
    f = models.fact_transactions(s)
    counts = {(r.model, r.column_name): r.failures
              for r in quality.null_counts(s, [("stg", "transaction_id"), ("fact", "amount")]).collect()}
    assert counts == {("stg", "transaction_id"): 1, ("fact", "amount"): 1}
    assert [(r.transaction_id, r.n) for r in quality.unique(f, "transaction_id").collect()] == [("a", 2)]
    assert quality.amount_non_negative(f).count() == 1
    assert quality.accepted(f, f["amount"] >= 0).count() == 1
    assert quality.not_null(f, ["transaction_id", "amount"]).count() == 1
    # null currency: unknown for the currency check, passes the foreign key
    assert quality.valid_currency(f, models.dim_currency(s)).count() == 1
    assert quality.foreign_key(f, "currency", models.dim_currency(s), "currency_code").count() == 0
    parent = spark.createDataFrame([("M9",)], "merchant_id string")
    assert quality.foreign_key(f, "merchant_id", parent, "merchant_id").count() == 3
    prof = {r.column_name: (r.row_count, r.null_count, r.null_pct, r.duplicate_keys)
            for r in quality.profile(s, "transaction_id").collect()}
    assert prof["transaction_id"] == (3, 1, 33.33, 1)


def test_profile_by_loads(spark, tmp_root):
    from cardlake.plans.key_index import KeyIndex
    from cardlake.plans.profiles import profile_load, read_profile
    schema = "k string, v int, w double"
    loads = [[("a", 1, None), ("a", 2, 1.0), (None, None, 1.0)], [], [("b", 3, 1.0), ("a", 4, 2.0)], [(None, 5, None)]]
    index = KeyIndex(spark, f"{tmp_root}/i", key="k", buckets=2)
    for number, rows in [*enumerate(loads), (2, loads[2])]:
        profile_load(spark.createDataFrame(rows, schema), f"l{number}", f"{tmp_root}/p", index)
    whole = spark.createDataFrame([r for rows in loads for r in rows], schema)
    want = {tuple(r) for r in quality.profile(whole, "k").collect()}
    got = read_profile(spark, f"{tmp_root}/p").collect()
    assert {tuple(r)[:5] for r in got} == want and {r.duplicate_keys for r in got} == {2}
    assert {r.column_name: r.approx_distinct for r in got} == {"k": 2, "v": 5, "w": 2}
    none = quality.profile(whole.where("false"), "k").collect()
    assert {(r.row_count, r.null_count, r.null_pct, r.duplicate_keys) for r in none} == {(0, 0, None, 0)}
