import pytest
import datetime as dt

from pyspark.sql import functions as F

from cardlake.operators import layers, rules
from cardlake.operators.card_rules import flag_card_rules
from cardlake.schemas import BRONZE, PARSED, SILVER
from cardlake.streaming.card_state import card_rule_schema, flag_card_rules_stream
from cardlake.streaming.jobs import read_warehouse, run_silver, run_warehouse, warehouse_writer
from cardlake.streaming.sinks import parquet_sink
from tests.helpers import payment, payments_df

DAY5 = 4 * 86400


def _bronze(spark, rows):
    return rules.flag_stateless(payments_df(spark, rows)).select(*BRONZE.fieldNames())


def test_silver_restart_dedup_and_late_rows(spark, tmp_root):
    src, out, chk = f"{tmp_root}/bronze", f"{tmp_root}/silver", f"{tmp_root}/chk"
    _bronze(spark, [payment("a", 5, sec=DAY5), payment("b", 6, sec=DAY5 + 1)]) \
        .write.mode("append").partitionBy("date").parquet(src)
    run_silver(spark, src, out, chk, processed_at="2024-02-01 00:00:00")
    assert spark.read.schema(SILVER).parquet(out).count() == 2
    # second delivery: a repeat of a, a row two days behind, a new row
    _bronze(spark, [payment("a", 5, sec=DAY5), payment("c", 7, sec=2 * 86400),
                    payment("d", 8, sec=DAY5 + 2)]).write.mode("append").partitionBy("date").parquet(src)
    run_silver(spark, src, out, chk, processed_at="2024-02-01 00:00:00")
    ids = sorted(r.transaction_id for r in spark.read.schema(SILVER).parquet(out).collect())
    assert ids == ["a", "b", "d"]


def test_warehouse_writer_is_idempotent_per_batch(spark, tmp_root):
    batch = layers.to_warehouse(layers.to_silver(_bronze(spark, [payment("a", 5), payment("b", 6)]),
                                                 processed_at="2024-02-01 00:00:00"))
    for generation in ("11111111-aaaa", "22222222-bbbb"):
        spark.createDataFrame([(f'{{"id":"{generation}"}}',)], "value string").coalesce(1) \
            .write.text(f"{tmp_root}/{generation}/metadata")
        write = warehouse_writer(f"{tmp_root}/wh", checkpoint=f"{tmp_root}/{generation}")
        write(batch, 7)
        write(batch, 7)          # retried batch replaces itself
        write(batch.limit(0), 8)  # empty batch: nothing written
    # a new checkpoint counts its batches from 0 again and leaves older loads alone
    assert read_warehouse(spark, f"{tmp_root}/wh").count() == 4


def test_warehouse_days_are_pruned(spark, tmp_root):
    silver = layers.to_silver(_bronze(spark, [payment(f"t{i}", i, sec=i * 86400) for i in range(9)]),
                              processed_at="2024-02-01 00:00:00")
    silver.write.partitionBy("date").parquet(f"{tmp_root}/silver")
    run_warehouse(spark, f"{tmp_root}/silver", f"{tmp_root}/chk",
                  warehouse_writer(f"{tmp_root}/wh", checkpoint=f"{tmp_root}/chk"))
    day = read_warehouse(spark, f"{tmp_root}/wh").filter("date = date'2024-01-03'")
    assert day.count() == 1
    assert "PartitionFilters: [isnotnull(date" in day._jdf.queryExecution().executedPlan().toString()


def test_batch_bounds_exclude_each_other(spark):
    with pytest.raises(ValueError):
        run_silver(spark, "in", "out", "chk", max_files=1, max_bytes=1)


def test_warehouse_stream_equals_batch(spark, tmp_root):
    silver = layers.to_silver(_bronze(spark, [payment(f"t{i}", i, sec=i * 3600) for i in range(30)]),
                              processed_at="2024-02-01 00:00:00")
    silver.write.partitionBy("date").parquet(f"{tmp_root}/silver")
    run_warehouse(spark, f"{tmp_root}/silver", f"{tmp_root}/chk", 
                  warehouse_writer(f"{tmp_root}/wh", checkpoint=f"{tmp_root}/chk"), max_files=1)
    got = read_warehouse(spark, f"{tmp_root}/wh").select(*layers.to_warehouse(silver).columns)
    assert got.exceptAll(layers.to_warehouse(silver)).count() == 0
    assert got.count() == 30


def test_card_state_stream_equals_batch_with_ties(spark, tmp_root):
    import random
    rnd = random.Random(7)
    rows = [payment(f"x{i:03d}", card=f"c{rnd.randrange(3)}", sec=rnd.randrange(0, 90) * 20,
                    location=rnd.choice(["UK", "USA", None]), auth=rnd.choice(["APPROVED", "DECLINED"]))
            for i in range(240)]
    df = payments_df(spark, rows)
    batch = flag_card_rules(rules.flag_blacklist(rules.flag_high_amount(df)).withColumnRenamed("date", "event_date"))
    cut = F.lit(dt.datetime(2024, 1, 1, 12, 15))
    for part in (df.filter(F.col("event_ts") < cut), df.filter(F.col("event_ts") >= cut)):
        part.write.mode("append").parquet(f"{tmp_root}/in")
        stream = flag_card_rules_stream(spark.readStream.schema(PARSED).parquet(f"{tmp_root}/in"))
        parquet_sink(stream, f"{tmp_root}/out", f"{tmp_root}/chk", trigger="available_now").awaitTermination()
    got = spark.read.schema(card_rule_schema()).parquet(f"{tmp_root}/out")
    cols = ["transaction_id", "rule_velocity", "rule_cross_border", "rule_decline_rate"]
    assert got.count() == 240
    assert got.select(*cols).exceptAll(batch.select(*cols)).count() == 0


def test_silver_dedup_on_id_within_watermark(spark, tmp_root):
    src = f"{tmp_root}/bronze"
    _bronze(spark, [payment("a", 5, sec=DAY5), payment("a", 5, sec=DAY5 + 30), payment("b", 6, sec=DAY5)]) \
        .write.parquet(src)
    s = spark.readStream.schema(BRONZE).parquet(src)
    out = layers.to_silver(s, keys=["transaction_id"], within_watermark=True,
                           processed_at="2024-02-01 00:00:00")
    parquet_sink(out, f"{tmp_root}/silver", f"{tmp_root}/chk", trigger="available_now").awaitTermination()
    assert sorted(r.transaction_id for r in spark.read.parquet(f"{tmp_root}/silver").collect()) == ["a", "b"]


def test_stream_negative_first_copy_suppresses_later_copy(spark, tmp_root):
    src, out, chk = f"{tmp_root}/bronze", f"{tmp_root}/silver", f"{tmp_root}/chk"
    _bronze(spark, [payment("a", -1, sec=DAY5)]).write.mode("append").parquet(src)
    run_silver(spark, src, out, chk)
    _bronze(spark, [payment("a", 5, sec=DAY5)]).write.mode("append").parquet(src)
    run_silver(spark, src, out, chk)
    assert spark.read.schema(SILVER).parquet(out).count() == 0


def test_card_state_function_null_time():
    import pandas as pd
    from cardlake.streaming.card_state import make_state_fn

    class FakeState:
        exists, hasTimedOut = False, False

        def update(self, v):
            self.value = v

        def getCurrentWatermarkMs(self):
            return 0

        def setTimeoutTimestamp(self, t):
            self.timeout = t

    rows = [payment("a", sec=0), payment("b", sec=5)]
    pdf = pd.DataFrame([r[:10] + (r[10], r[11], False, False) for r in rows],
                       columns=["transaction_id", "ts_event", "card_hash", "merchant_id", "amount", "currency",
                                "mcc", "channel", "auth_result", "location", "event_ts", "event_date",
                                "rule_high_amount", "rule_blacklist"])
    pdf.loc[1, "event_ts"] = pd.NaT
    st = FakeState()
    out = pd.concat(list(make_state_fn()(("c1",), iter([pdf]), st)))
    assert out.set_index("transaction_id").loc["b", "rule_velocity"] is None
    assert bool(out.set_index("transaction_id").loc["a", "rule_velocity"]) is False
    assert len(st.value[0]) == 1


def test_progress_recorder_reports_rows_and_state(spark, tmp_root):
    import time

    from cardlake.streaming.monitor import record_progress
    rec = record_progress(spark)
    try:
        silver = layers.to_silver(_bronze(spark, [payment(f"t{i}", i, sec=i * 3600) for i in range(20)]),
                                  processed_at="2024-02-01 00:00:00")
        silver.write.partitionBy("date").parquet(f"{tmp_root}/silver")
        run_warehouse(spark, f"{tmp_root}/silver", f"{tmp_root}/chk",
                      warehouse_writer(f"{tmp_root}/wh", checkpoint=f"{tmp_root}/chk"))
        df = payments_df(spark, [payment(f"x{i}", card=f"c{i % 3}", sec=i) for i in range(30)])
        df.write.parquet(f"{tmp_root}/in")
        stream = flag_card_rules_stream(spark.readStream.schema(PARSED).parquet(f"{tmp_root}/in"))
        parquet_sink(stream, f"{tmp_root}/out", f"{tmp_root}/chk2", trigger="available_now").awaitTermination()
        time.sleep(2)    # listener events are delivered asynchronously
        s = rec.summary()
        assert sum(r["observed"].get("warehouse_batch", {}).get("rows", 0) for r in s) == 20
        assert max(r["state_rows"] for r in s) == 3      # one state row per card
        wh = [r for r in s if "warehouse_batch" in r["observed"]]
        assert sum(r["input_rows"] for r in wh) == 20    # each micro-batch read once
    finally:
        spark.streams.removeListener(rec)


def test_card_state_late_row_sees_earlier_events_only():
    import random

    import pandas as pd

    from cardlake.streaming.card_state import make_state_fn
    from tests.test_card_rules import fold

    class State:
        def __init__(self):
            self.value, self.exists, self.hasTimedOut = None, False, False

        def update(self, v):
            self.value, self.exists = v, True

        @property
        def get(self):
            return self.value

        def getCurrentWatermarkMs(self):
            return 0

        def setTimeoutTimestamp(self, t):
            pass

    cols = ["transaction_id", "ts_event", "card_hash", "merchant_id", "amount", "currency", "mcc", "channel",
            "auth_result", "location", "event_ts", "event_date", "rule_high_amount", "rule_blacklist"]
    rnd = random.Random(5)
    rows = [payment(f"x{i:03d}", sec=rnd.randrange(0, 40) * 15, location=rnd.choice(["UK", "USA"]),
                    auth=rnd.choice(["APPROVED", "DECLINED"])) for i in range(120)]
    early, late = rows[:100], rows[100:]          # late rows arrive in a second batch, out of order
    fn, st = make_state_fn(), State()

    def frame(rs):
        return pd.DataFrame([r + (False, False) for r in rs], columns=cols)

    list(fn(("c1",), iter([frame(early)]), st))
    out = pd.concat(list(fn(("c1",), iter([frame(late)]), st)))
    want = fold(rows)
    got = {r.transaction_id: (bool(r.rule_velocity), bool(r.rule_cross_border), bool(r.rule_decline_rate))
           for r in out.itertuples()}
    assert got == {k: want[k] for k in got}


def test_card_state_stream_in_non_utc_session(spark, tmp_root):
    """Same flags and a working timeout when the session zone is not UTC."""
    rows = [payment(f"x{i:03d}", card="c1", sec=i * 8, location=["UK", "USA"][i % 2],
                    auth=["DECLINED", "APPROVED", "DECLINED"][i % 3]) for i in range(40)]
    df = payments_df(spark, rows)
    want = {r.transaction_id: (r.rule_velocity, r.rule_cross_border, r.rule_decline_rate)
            for r in flag_card_rules(rules.flag_blacklist(rules.flag_high_amount(df))
                                     .withColumnRenamed("date", "event_date")).collect()}
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df.write.parquet(f"{tmp_root}/in")
        stream = flag_card_rules_stream(spark.readStream.schema(PARSED).parquet(f"{tmp_root}/in"))
        parquet_sink(stream, f"{tmp_root}/out", f"{tmp_root}/chk", trigger="available_now").awaitTermination()
        got = {r.transaction_id: (r.rule_velocity, r.rule_cross_border, r.rule_decline_rate)
               for r in spark.read.schema(card_rule_schema()).parquet(f"{tmp_root}/out").collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == want


def test_card_rules_keep_every_payload_and_split_a_hot_card(spark, tmp_root):
    """One card with a third of all rows, late rows in a second drain, a batch run twice."""
    import random

    from cardlake.operators.card_rules import flag_card_rules
    from cardlake.operators.rules import flag_blacklist, flag_high_amount
    from cardlake.streaming.jobs import await_all, start_card_rules_ingest
    rnd = random.Random(11)
    rows = [payment(f"x{i:04d}", card="hot" if i % 3 == 0 else f"c{rnd.randrange(40)}", sec=rnd.randrange(0, 7200),
                    location=rnd.choice(["UK", "USA", None]), auth=rnd.choice(["APPROVED", "DECLINED"]),
                    amount=None if i % 50 == 0 else 5.0) for i in range(900)]
    late = [r for i, r in enumerate(rows) if i % 10 == 0]
    early = [r for i, r in enumerate(rows) if i % 10]
    for part in (early, late):
        payments_df(spark, part).write.mode("append").parquet(f"{tmp_root}/in")
        await_all(start_card_rules_ingest(
            spark.readStream.schema(PARSED).parquet(f"{tmp_root}/in"), f"{tmp_root}/decided", f"{tmp_root}/chk",
            dlq_path=f"{tmp_root}/dlq", trigger="available_now", payloads=False))
    decided = spark.read.parquet(f"{tmp_root}/decided")
    letters = spark.read.parquet(f"{tmp_root}/dlq").selectExpr(
        "get_json_object(value, '$.transaction_id') id", "get_json_object(value, '$.error_reason') reason").collect()
    too_late = {r.id for r in letters if r.reason == "LATE_EVENT"}
    ids = [r[0] for r in decided.select("transaction_id").collect()]
    assert len(ids) == len(set(ids)) and not too_late & set(ids)
    assert set(ids) | too_late == {r[0] for r in rows} and too_late
    undecided = {r.transaction_id for r in decided.filter("is_fraud is null").collect()}
    assert undecided <= {r.id for r in letters if r.reason == "MISSING_AMOUNT"}
    # the first drain equals the table form; a late row in time sees what came before it
    flags = ("rule_velocity", "rule_cross_border", "rule_decline_rate")
    got = {r.transaction_id: tuple(r[f] for f in flags) for r in decided.collect()}

    def table(part):
        p = flag_blacklist(flag_high_amount(payments_df(spark, part)))
        return {r.transaction_id: tuple(r[f] for f in flags) for r in flag_card_rules(p).collect()}
    first = table(early)
    assert {k: v for k, v in got.items() if k in first} == first
    in_time = [r for r in late if r[0] not in too_late]
    both = table(early + in_time)
    assert in_time and all(got[r[0]] == both[r[0]] for r in in_time)


def test_first_seen_copy_is_kept_in_table_and_stream(spark, tmp_root):
    rows = [payment("a", 9), payment("a", 3), payment("b", -1), payment("b", 4), payment("c", 2), payment("c", -2)]
    bronze = _bronze(spark, rows).coalesce(1)
    table = {r.transaction_id: r.amount for r in layers.to_silver(bronze).collect()}
    bronze.write.partitionBy("date").parquet(f"{tmp_root}/bronze")
    run_silver(spark, f"{tmp_root}/bronze", f"{tmp_root}/silver", f"{tmp_root}/chk")
    stream = {r.transaction_id: r.amount for r in spark.read.schema(SILVER).parquet(f"{tmp_root}/silver").collect()}
    assert table == stream == {"a": 9.0, "c": 2.0}      # b's first copy is negative: both copies go
