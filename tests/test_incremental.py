"""Incremental refresh equals a full rebuild, round after round."""

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from cardlake.operators import layers, rules
from cardlake.plans.build import build_models
from cardlake.plans.incremental import published, refresh_models
from cardlake.plans.snapshots import read_table
from cardlake.sources import fixtures
from tests.conftest import SMOKE

NAMES = ("fact_transactions", "fact_fraud_signals", "dim_merchants", "dim_currency", "dim_auth_results",
         "mart_settlement_daily", "mart_fraud_settlement_daily", "mart_fraud_rate",
         "mart_currency_volume", "mart_channel_performance", "mart_fraud_alerts")


def _same(a, b):
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    a, b = a.select(*cols), b.select(*cols)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_incremental_refresh_equals_full_build(spark, tmp_root):
    bronze = rules.flag_stateless(fixtures.payments(spark, SMOKE))
    wh = layers.to_warehouse(layers.with_processed_at(bronze, "2024-02-01 00:00:00"))
    d = F.col("date")
    r1 = wh.filter(d < F.lit("2024-01-11").cast("date"))
    late = wh.filter((d >= F.lit("2024-01-05").cast("date")) & (d < F.lit("2024-01-06").cast("date"))
                     & (F.col("transaction_id").endswith("7")))
    r1 = r1.exceptAll(late)
    r2 = wh.filter((d >= F.lit("2024-01-11").cast("date")) & (d < F.lit("2024-01-21").cast("date"))).unionByName(late)
    # round 3 brings a new dimension row for an existing merchant (new location and channel)
    r3 = wh.filter(d >= F.lit("2024-01-21").cast("date"))
    novel = (wh.filter(F.col("merchant_id") == "M1005").limit(3)
               .withColumn("location", F.lit("Mars")).withColumn("channel", F.lit("MOTO"))
               .withColumn("transaction_id", F.concat(F.col("transaction_id"), F.lit("X")))
               .withColumn("date", F.lit("2024-01-25").cast("date")))
    r3 = r3.unionByName(novel)
    out = f"{tmp_root}/models"
    seen = None
    for rnd in (r1, r2, r3):
        rnd = spark.createDataFrame(rnd.collect(), rnd.schema)     # freeze this round's rows
        days = sorted(str(r[0]) for r in rnd.select("date").distinct().collect())
        seen = rnd if seen is None else seen.unionByName(rnd)
        got = refresh_models(seen, out, days=days)
        want = build_models(seen)
        for name in NAMES:
            assert _same(got[name], want[name]), name
    # the new dimension row reached old days: a MOTO channel row on a day before the 25th
    moto = got["mart_channel_performance"].filter("channel = 'MOTO' and date < date'2024-01-21'")
    assert moto.count() > 0


def test_hourly_refresh_incremental_rounds(spark, tmp_root):
    from cardlake.plans.refresh import LakePaths, hourly_refresh
    from cardlake.streaming.jobs import read_warehouse
    paths = LakePaths(tmp_root)
    bronze = rules.flag_stateless(fixtures.payments_dirty(spark, SMOKE))
    d = F.col("date")
    cut = F.lit("2024-01-15").cast("date")
    bronze.filter(d < cut).write.partitionBy("date").parquet(paths.bronze)
    hourly_refresh(spark, paths, processed_at="2024-02-01 00:00:00")
    bronze.filter(d >= cut).write.mode("append").partitionBy("date").parquet(paths.bronze)
    got = hourly_refresh(spark, paths, processed_at="2024-02-01 00:00:00")
    want = build_models(read_warehouse(spark, paths.warehouse))
    for name in NAMES:
        assert _same(got[name], want[name]), name
    again = hourly_refresh(spark, paths, processed_at="2024-02-01 00:00:00")   # nothing new
    assert _same(again["mart_settlement_daily"], want["mart_settlement_daily"])


def _three_rounds(spark):
    wh = layers.to_warehouse(layers.with_processed_at(rules.flag_stateless(fixtures.payments(spark, SMOKE)),
                                                      "2024-02-01 00:00:00")).filter("date < date'2024-01-09'")
    wh = wh.withColumn("date", F.when(~F.col("transaction_id").endswith("4"), F.col("date")))   # some have no date
    novel = (wh.limit(4).withColumn("location", F.lit("Mars")).withColumn("channel", F.lit("MOTO"))
             .withColumn("transaction_id", F.concat("transaction_id", F.lit("X")))
             .withColumn("date", F.lit("2024-01-07").cast("date")))
    second = (F.col("date") >= F.lit("2024-01-06").cast("date")) | F.col("transaction_id").endswith("34")
    freeze = lambda df: spark.createDataFrame(df.collect(), wh.schema)
    return freeze(wh.filter(~F.coalesce(second, F.lit(False)))), freeze(
        wh.filter(F.coalesce(second, F.lit(False))).unionByName(novel))


def _dates(df):
    return [None if r[0] is None else str(r[0]) for r in df.select("date").distinct().collect()]


# of the 16 writes: facts and dimensions, bases, row tables, marts, publication
@pytest.mark.parametrize("step", [4, 9, 13, 15])
def test_a_refresh_that_stops_anywhere_is_made_up_for(spark, tmp_root, monkeypatch, step):
    """The step-th write of the second refresh fails; the next refresh equals a full build."""
    first, second = _three_rounds(spark)
    out, seen = f"{tmp_root}/models", first.unionByName(second)
    refresh_models(first, out, loads=[("g", 0)])
    assert published(spark, out)[:2] == (1, [("g", 0)])
    write, calls = DataFrameWriter.parquet, []

    def failing(self, path, *a, **kw):
        calls.append(path)
        if len(calls) > step:
            raise RuntimeError("stopped")
        return write(self, path, *a, **kw)
    monkeypatch.setattr(DataFrameWriter, "parquet", failing)
    with pytest.raises(RuntimeError, match="stopped"):
        refresh_models(seen, out, days=_dates(second), loads=[("g", 1)])
    monkeypatch.setattr(DataFrameWriter, "parquet", write)
    assert published(spark, out)[1] == [("g", 0)]       # the next refresh begins where the first ended
    watched = ("fact_transactions", "dim_merchants", "mart_channel_performance")
    held = {n: read_table(spark, out, n) for n in watched}
    before = {n: build_models(first)[n] for n in watched}
    for name in watched:                                # readers have the first refresh, whole
        assert _same(held[name], before[name]), name
    got, want = refresh_models(seen, out, days=_dates(second), loads=[("g", 1)]), build_models(seen)
    assert published(spark, out)[:2] == (2, [("g", 1)])
    for name in NAMES:
        assert _same(got[name], want[name]), name
    for name in watched:                                # also who opened them before the second
        assert _same(held[name], before[name]), name


def test_exact_form_and_change_of_models(spark, tmp_root):
    first, second = _three_rounds(spark)
    out, seen = f"{tmp_root}/models", first.unionByName(second)
    refresh_models(first, out, marts=["mart_fraud_alerts"])
    got = refresh_models(seen, out, days=_dates(second), one_row_per_merchant=True)
    want = build_models(seen, one_row_per_merchant=True)
    for name in NAMES:
        assert _same(got[name], want[name]), name
