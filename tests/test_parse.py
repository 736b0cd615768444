import json

from cardlake.operators.parse import parse_payments
from cardlake.operators.routing import dead_letter


def _line(**kw):
    base = {"transaction_id": "T1", "ts_event": "2024-01-01T00:00:01.000000+00:00", "card_hash": "c",
            "merchant_id": "M1003", "amount": 5.0, "currency": "USD", "mcc": "5411",
            "channel": "POS", "auth_result": "APPROVED", "location": "UK"}
    base.update(kw)
    return json.dumps(base)


def test_bad_payloads_are_invalid_without_exceptions(spark):
    values = ["{bad", "[]", "null", "", None, '{"other":1}', _line(amount="x"),
              _line(ts_event="zzz"), _line(transaction_id="OK1")]
    lines = spark.createDataFrame([(v,) for v in values], "value string")
    valid, invalid = parse_payments(lines, as_of="2024-02-01 00:00:00")
    assert [r.transaction_id for r in valid.collect()] == ["OK1"]
    reasons = sorted((r.error_reason, r.raw_value) for r in invalid.collect()
                     if r.raw_value is not None)
    got = {raw: reason for reason, raw in reasons}
    assert got["{bad"] == "INVALID_JSON"
    assert got["[]"] == "INVALID_JSON"
    assert got["null"] == "INVALID_JSON"
    assert got[""] == "EMPTY_PAYLOAD"
    assert got['{"other":1}'] == "MISSING_ID"
    assert got[_line(amount="x")] == "INVALID_JSON"
    assert got[_line(ts_event="zzz")] == "INVALID_EVENT_TS"
    assert invalid.filter("raw_value is null").first().error_reason == "EMPTY_PAYLOAD"
    assert invalid.count() == 8


def test_valid_row_has_time_and_day(spark):
    lines = spark.createDataFrame([(_line(),)], "value string")
    row = parse_payments(lines)[0].first()
    assert str(row.event_ts) == "2024-01-01 00:00:01"
    assert str(row.date) == "2024-01-01"


def test_dead_letter_envelope(spark):
    lines = spark.createDataFrame([("{bad",), (_line(),)], "value string")
    valid, invalid = parse_payments(lines, as_of="2024-02-01 00:00:00")
    out = dead_letter(valid, invalid, as_of="2024-02-01 00:00:00").collect()
    by_reason = {json.loads(r.value)["error_reason"]: r for r in out}
    assert by_reason["FRAUD_DETECTED"].key == "c"
    assert by_reason["INVALID_JSON"].key is None
    assert json.loads(by_reason["INVALID_JSON"].value)["raw_value"] == "{bad"


def test_producer_style_payloads(spark):
    import datetime as dt
    recs = [{"transaction_id": "TXN123456", "ts_event": dt.datetime(2024, 1, 2, 3, 4, 5, tzinfo=dt.timezone.utc).isoformat(),
             "card_hash": "ab" * 20, "merchant_id": "M1001", "amount": 12000.5, "currency": "USD", "mcc": "5411",
             "channel": "POS", "auth_result": "DECLINED", "location": "UK"},
            {"transaction_id": "TXN654321",
             "ts_event": dt.datetime(2024, 1, 2, 3, 4, 5, 120000, tzinfo=dt.timezone.utc).isoformat(),
             "card_hash": "cd" * 20, "merchant_id": "M5000", "amount": 3.0, "currency": "USD", "mcc": "5411",
             "channel": "ECOM", "auth_result": "APPROVED", "location": "India"}]
    lines = spark.createDataFrame([(json.dumps(r).encode(),) for r in recs], "value binary")  # topic bytes
    valid, invalid = parse_payments(lines)
    rows = {r.transaction_id: r for r in valid.collect()}
    assert invalid.count() == 0
    assert str(rows["TXN123456"].event_ts) == "2024-01-02 03:04:05"
    assert str(rows["TXN654321"].event_ts) == "2024-01-02 03:04:05.120000"


def test_day_is_utc_whatever_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        lines = spark.createDataFrame([(_line(ts_event="2024-01-01T03:00:00+00:00"),)], "value string")
        row = parse_payments(lines)[0].first()
        assert str(row.date) == "2024-01-01"          # 2023-12-31 in Los Angeles
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_time_without_offset_is_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        lines = spark.createDataFrame([(_line(transaction_id="A", ts_event="2024-01-01T23:30:00"),),
                                       (_line(transaction_id="B", ts_event="2024-01-01 23:30:00.5"),),
                                       (_line(transaction_id="C", ts_event="2024-01-01T23:30:00+05:30"),)],
                                      "value string")
        epoch = {r.transaction_id: r.s for r in parse_payments(lines)[0]
                 .selectExpr("transaction_id", "unix_micros(event_ts) s").collect()}
        assert epoch["A"] == 1704151800000000             # 2024-01-01 23:30 UTC
        assert epoch["B"] == 1704151800500000
        assert epoch["C"] == 1704151800000000 - 19800000000
        assert {r.transaction_id: str(r.date) for r in parse_payments(lines)[0].collect()}["A"] == "2024-01-01"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_fixture_times_do_not_depend_on_session_zone(spark):
    from cardlake.sources import fixtures
    from tests.conftest import SMOKE

    def snapshot():
        return sorted((r.transaction_id, r.ts_event, str(r.date))
                      for r in fixtures.payments(spark, SMOKE).select("transaction_id", "ts_event", "date").collect())

    utc = snapshot()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert snapshot() == utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_single_pass_dead_letters_equal_the_union_form(spark):
    from cardlake.operators import rules
    from cardlake.operators.routing import dead_letters, undecided_as_invalid
    from cardlake.sources import fixtures
    from tests.conftest import SMOKE
    lines = fixtures.raw_lines(spark, SMOKE)
    valid, invalid = parse_payments(lines, as_of="2024-02-01 00:00:00")
    _, flagged, undecided = rules.route(rules.flag_stateless(valid))
    bad = invalid.unionByName(undecided_as_invalid(undecided, "2024-02-01 00:00:00"), allowMissingColumns=True)
    union = dead_letter(flagged, bad, as_of="2024-02-01 00:00:00")
    single = dead_letters(lines, as_of="2024-02-01 00:00:00")

    def canon(df):
        return sorted((r.key or "", json.dumps(json.loads(r.value), sort_keys=True)) for r in df.collect())
    assert canon(single) == canon(union)
    plan = single._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and "Union" not in plan
