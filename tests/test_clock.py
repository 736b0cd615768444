"""The stream clock: wrong dates don't move it, and clocks of parts merge to the clock of the whole."""

import random

from pyspark.sql import functions as F

from cardlake.operators.parse import FUTURE_EVENT, LATE_EVENT
from cardlake.schemas import PARSED
from cardlake.streaming.clock import clock_time, merged_clock, newest_cards, too_far_ahead
from cardlake.streaming.jobs import await_all, start_card_rules_ingest

BASE = 1_704_067_200


def _rows(spark, rows):
    return spark.createDataFrame([(c, None if s is None else BASE + s) for c, s in rows], "card_hash string, s double") \
        .select("card_hash", F.timestamp_seconds("s").alias("event_ts"))


def _time(spark, rows, support=3):
    t = clock_time(newest_cards(_rows(spark, rows), support))
    return None if t is None else t / 1e6 - BASE


def test_a_card_or_two_do_not_move_the_clock(spark):
    sane = [(f"c{i}", float(i)) for i in range(10)]
    assert _time(spark, sane) == 7.0
    assert _time(spark, sane + [("c1", 9e6)] * 50 + [("x", 9e6)]) == 9.0
    assert _time(spark, sane, support=1) == 9.0
    assert _time(spark, [("a", 5.0), ("a", 7.0), ("b", 3.0)]) == 3.0   # fewer cards than asked for
    assert _time(spark, [("a", None)]) is None and _time(spark, []) is None


def test_clocks_merge(spark):
    rng = random.Random(2)
    parts = [[(f"c{rng.randint(0, 12)}", float(rng.randint(0, 999))) for _ in range(40)] for _ in range(4)]
    clock = newest_cards(_rows(spark, parts[0]))
    for p in parts[1:]:
        clock = merged_clock(clock.unionByName(newest_cards(_rows(spark, p))))
    whole = newest_cards(_rows(spark, sum(parts, [])))
    assert clock_time(clock) == clock_time(whole) and clock.count() == 3


def test_ahead_of_arrival(spark):
    now = F.timestamp_seconds(F.lit(BASE))
    rows = _rows(spark, [("a", 900.0), ("b", 900.5), ("c", None), ("d", -9e8)])
    got = rows.select("card_hash", too_far_ahead(now, 900).alias("f")).collect()
    assert {r.card_hash: r.f for r in got} == {"a": False, "b": True, "c": False, "d": False}


def test_payment_of_2034_leaves_all_others_decided(spark, tmp_root):
    def row(i, card, s):
        return (f"T{i:03d}", None, card, "M1", 1.0, "USD", "5411", "POS", "APPROVED", "UK", BASE + s)
    drains = [[row(0, "a", 0), row(1, "b", 10), row(2, "a", 315_360_000), row(3, "c", 20), row(4, "d", 30)],
              [row(i, "abcd"[i % 4], 40 + i) for i in range(5, 22)] + [row(22, "a", -2000)]]
    names = [f.name for f in PARSED.fields]
    for rows in drains:
        df = spark.createDataFrame(rows, "transaction_id string, ts_event string, card_hash string, merchant_id string, "
                                   "amount double, currency string, mcc string, channel string, auth_result string, "
                                   "location string, s long")
        df = df.withColumn("event_ts", F.timestamp_seconds("s")).withColumn("date", F.to_date("event_ts")).select(*names)
        df.coalesce(1).write.mode("append").parquet(f"{tmp_root}/in")
        await_all(start_card_rules_ingest(spark.readStream.schema(PARSED).parquet(f"{tmp_root}/in"), f"{tmp_root}/out",
                                          f"{tmp_root}/chk", dlq_path=f"{tmp_root}/dlq", trigger="available_now",
                                          payloads=False, as_of="2024-01-01 01:00:00"))
    decided = {r.transaction_id: r.rule_velocity for r in spark.read.parquet(f"{tmp_root}/out").collect()}
    assert set(decided) == {f"T{i:03d}" for i in range(22)} - {"T002"}
    letters = spark.read.parquet(f"{tmp_root}/dlq").select(F.get_json_object("value", "$.transaction_id").alias("t"),
                                                          F.get_json_object("value", "$.error_reason").alias("e"))
    assert {(r.t, r.e) for r in letters.collect() if r.e.endswith("EVENT")} == {("T002", FUTURE_EVENT), ("T022", LATE_EVENT)}
