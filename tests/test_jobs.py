import pytest
from pyspark.sql import functions as F

from cardlake.operators import layers, rules
from cardlake.operators.card_rules import flag_all_rules
from cardlake.plans.build import build_models, build_order
from cardlake.plans.reports import export_report, read_report, retention_candidates
from cardlake.schemas import BRONZE, PARSED
from cardlake.sources import fixtures
from cardlake.sources.lines import text_stream, write_lines
from cardlake.streaming.jobs import (await_all, check_schema, late_rows, schema_of,
                                     start_card_rules_ingest, start_routed_ingest)
from tests.conftest import SMOKE


def _transactions(spark):
    b = rules.flag_stateless(fixtures.payments(spark, SMOKE))
    return layers.to_warehouse(layers.with_processed_at(b, "2024-02-01 00:00:00"))


def test_build_models_materialized_equals_lazy(spark, tmp_root):
    t = _transactions(spark)
    lazy = build_models(t)
    stored = build_models(t, out_path=f"{tmp_root}/models")
    assert build_order()[0] == "stg_transactions"
    for name in ("mart_settlement_daily", "mart_fraud_rate", "dim_merchants", "mart_fraud_alerts"):
        assert stored[name].exceptAll(lazy[name]).count() == 0
        assert lazy[name].exceptAll(stored[name]).count() == 0
    # a day report prunes the date-partitioned mart
    out = export_report(stored["mart_settlement_daily"], "2024-01-15", f"{tmp_root}/rep", files=1)
    back = read_report(spark, out, stored["mart_settlement_daily"].schema)
    assert back.count() == stored["mart_settlement_daily"].filter("date = date'2024-01-15'").count()
    plan = stored["mart_settlement_daily"].filter("date = date'2024-01-15'")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_card_rules_ingest_end_to_end(spark, tmp_root):
    fast = fixtures.payments_fast(spark, SMOKE)
    lines = fast.select(F.to_json(F.struct(*fixtures.RAW_FIELDS)).alias("value"))
    write_lines(lines, f"{tmp_root}/in")
    await_all(start_card_rules_ingest(text_stream(spark, f"{tmp_root}/in"), f"{tmp_root}/decided",
                                      f"{tmp_root}/chk", dlq_path=f"{tmp_root}/dlq", trigger="available_now"))
    got = spark.read.parquet(f"{tmp_root}/decided")
    want = flag_all_rules(fast)
    cols = ["transaction_id", "is_fraud", "fraud_reason"]
    assert got.count() == want.count()
    assert got.select(*cols).exceptAll(want.select(*cols)).count() == 0
    letters = spark.read.parquet(f"{tmp_root}/dlq").select(
        F.get_json_object("value", "$.error_reason").alias("r"))
    assert letters.filter("r = 'FRAUD_DETECTED'").count() == want.filter("is_fraud").count()


def test_routed_ingest_and_schema_check(spark, tmp_root):
    write_lines(fixtures.raw_lines(spark, SMOKE), f"{tmp_root}/in")
    await_all(start_routed_ingest(text_stream(spark, f"{tmp_root}/in"), f"{tmp_root}/clean",
                                  f"{tmp_root}/flagged", f"{tmp_root}/chk", dlq_path=f"{tmp_root}/dlq",
                                  trigger="available_now"))
    letters = spark.read.parquet(f"{tmp_root}/dlq").count()
    flagged_rows = spark.read.parquet(f"{tmp_root}/flagged").count()
    lines = fixtures.raw_lines(spark, SMOKE).count()
    assert spark.read.parquet(f"{tmp_root}/clean").count() + letters == lines and letters > flagged_rows
    with pytest.raises(ValueError):
        start_routed_ingest(None, "a", "b", "c")
    clean = spark.read.parquet(f"{tmp_root}/clean")
    flagged = spark.read.parquet(f"{tmp_root}/flagged")
    assert clean.filter("is_fraud").count() == 0 and flagged.filter("not is_fraud").count() == 0
    assert check_schema(BRONZE, schema_of(spark, f"{tmp_root}/clean")) == []
    assert check_schema(BRONZE, PARSED)[:1] == ["missing rule_high_amount"]


def test_late_rows_and_retention(spark):
    p = fixtures.payments(spark, SMOKE)
    late = late_rows(p, "2024-01-03 00:00:00", 86400)
    assert late.count() == p.filter("event_ts < timestamp'2024-01-02 00:00:00'").count()
    old = retention_candidates(rules.flag_stateless(p), "2024-02-15", 30)
    assert old.agg({"date": "max"}).first()[0].isoformat() == "2024-01-15"


def test_hourly_refresh_then_daily_reports(spark, tmp_root):
    from cardlake.plans.refresh import LakePaths, daily_reports, hourly_refresh
    paths = LakePaths(tmp_root)
    bronze = rules.flag_stateless(fixtures.payments_dirty(spark, SMOKE))
    bronze.write.partitionBy("date").parquet(paths.bronze)
    built = hourly_refresh(spark, paths, processed_at="2024-02-01 00:00:00")
    want = layers.to_warehouse(layers.to_silver(bronze, processed_at="2024-02-01 00:00:00"))
    assert built["fact_transactions"].count() == want.count()
    out = daily_reports(built, "2024-01-15", paths)
    assert spark.read.option("header", True).csv(out["settlement"]).count() == \
        built["mart_settlement_daily"].filter("date = date'2024-01-15'").count()
    # a second run with no new files changes nothing
    again = hourly_refresh(spark, paths, processed_at="2024-02-01 00:00:00")
    assert again["fact_transactions"].count() == want.count()


def test_cli_ingest_refresh_report(spark, tmp_root):
    from cardlake.plans.cli import main
    write_lines(fixtures.raw_lines(spark, SMOKE), f"{tmp_root}/payloads")
    main(["ingest", "--root", tmp_root, "--lines", f"{tmp_root}/payloads", "--trigger", "available_now"], spark)
    built = main(["refresh", "--root", tmp_root], spark)
    assert "mart_settlement_daily" in built["models"]
    out = main(["report", "--root", tmp_root, "--as-of", "2024-01-15"], spark)
    assert spark.read.option("header", True).csv(out["settlement"]).count() > 0
    letters = spark.read.parquet(f"{tmp_root}/deadletter")
    assert letters.count() > 0


def test_archive_partitions_is_rerunnable(spark, tmp_root):
    from cardlake.plans.reports import archive_partitions
    old = retention_candidates(rules.flag_stateless(fixtures.payments(spark, SMOKE)), "2024-02-15", 30)
    n = old.count()
    late = F.col("transaction_id").endswith("5")
    archive_partitions(old.filter(~late), f"{tmp_root}/archive", "r1")
    archive_partitions(old.filter(~late), f"{tmp_root}/archive", "r1")   # the same run again replaces itself
    archive_partitions(old.filter(late), f"{tmp_root}/archive", "r2")    # late rows of archived days are added
    archive_partitions(old, f"{tmp_root}/archive", "r3")                 # nothing new: nothing repeated
    assert spark.read.parquet(f"{tmp_root}/archive").count() == n
    newer = retention_candidates(rules.flag_stateless(fixtures.payments(spark, SMOKE)), "2024-02-16", 30)
    archive_partitions(newer, f"{tmp_root}/archive", "r4")     # adds one more day, keeps the others
    got = spark.read.parquet(f"{tmp_root}/archive")
    assert got.count() == newer.count() and newer.count() > n
