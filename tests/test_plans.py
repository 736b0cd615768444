"""Plan shape checks: the scale properties the operators are designed for."""

import re

from cardlake.operators import layers, models, rules
from cardlake.operators.card_rules import flag_all_rules
from cardlake.operators.parse import parse_payments
from cardlake.sources import fixtures
from tests.conftest import SMOKE


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _static(spark, fn):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return fn()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_card_rules_one_shuffle_one_sort(spark):
    plan = _static(spark, lambda: _plan(flag_all_rules(fixtures.payments_fast(spark, SMOKE))))
    assert plan.count("Exchange hashpartitioning(card_hash") == 1
    assert len(re.findall(r"\bSort \[", plan)) == 1
    assert "collect_list" not in plan


def test_parse_reads_json_once(spark):
    valid, invalid = parse_payments(fixtures.raw_lines(spark, SMOKE))
    assert _optimized(valid).count("from_json") == 1
    assert _optimized(invalid).count("from_json") == 1


def test_literal_blacklist_needs_no_join(spark):
    plan = _plan(rules.flag_stateless(fixtures.payments(spark, SMOKE)))
    assert "Join" not in plan and "Exchange" not in plan


def test_marts_aggregate_before_joining(spark):
    b = rules.flag_stateless(fixtures.payments(spark, SMOKE))
    stg = models.stg_transactions(layers.to_warehouse(layers.with_processed_at(b)))
    f, d = models.fact_transactions(stg), models.dim_merchants(stg)
    for mart in (models.mart_settlement_daily(f, d), models.mart_fraud_rate(models.fact_fraud_signals(stg), d),
                 models.mart_fraud_settlement_daily(f, d)):
        opt = _optimized(mart)
        # the join's fact side is an Aggregate, never raw fact rows
        join_at = opt.index("Join Inner")
        assert "Aggregate [date" in opt[join_at:]
        assert "Generate" not in opt


def test_scan_prunes_columns(spark):
    f = models.fact_transactions(models.stg_transactions(layers.to_warehouse(layers.with_processed_at(
        rules.flag_stateless(fixtures.payments(spark, SMOKE))))))
    plan = _plan(f.groupBy("currency").count())
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "user_id" not in read     # card_hash is not needed for this aggregate


def test_cluster_conf_scales_with_input():
    from cardlake.session import cluster_conf
    big = cluster_conf(100 * 1024 ** 4, 4000)          # 100 TB on 4000 cores
    assert int(big["spark.sql.shuffle.partitions"]) == 409600
    small = cluster_conf(1024 ** 3, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 24


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "collect_list",
             "collect_set")


def test_no_registered_query_plans_a_product_or_python_udf(spark):
    import __spark_entry__ as E
    for name, q in sorted(E.queries().items()):
        if name.startswith(("stream_", "src_", "report_")):
            continue    # these run their jobs eagerly; the result is a file scan
        plan = _plan(q(spark, SMOKE))
        bad = [f for f in FORBIDDEN if f in plan]
        assert not bad, f"{name}: {bad}"


def test_retention_prunes_bronze_partitions(spark, tmp_root):
    from cardlake.plans.reports import retention_candidates
    rules.flag_stateless(fixtures.payments(spark, SMOKE)).write.partitionBy("date").parquet(f"{tmp_root}/bronze")
    table = spark.read.parquet(f"{tmp_root}/bronze")
    old = retention_candidates(table, "2024-02-15", 30)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = old._jdf.queryExecution().explainString(mode)
    assert re.search(r"PartitionFilters: \[isnotnull\(date#\d+\), \(date#\d+ < 2024-01-16\)\]", text)
    assert old.select("date").distinct().count() == 15 < table.select("date").distinct().count()


def test_silver_dedup_combines_before_the_shuffle(spark):
    b = rules.flag_stateless(fixtures.payments_dirty(spark, SMOKE))
    plan = _static(spark, lambda: _plan(layers.to_silver(b, processed_at="2024-02-01 00:00:00")))
    below = plan.split("Exchange hashpartitioning(transaction_id", 1)[1]
    assert "partial_min(" in below               # map-side combine of repeated keys
    assert "Window" not in plan                  # no row_number over a whole key group


def test_mart_distinct_count_spreads_hot_groups(spark):
    import __spark_entry__ as E
    plan = _static(spark, lambda: _plan(E.queries()["mart_settlement_daily"](spark, SMOKE)))
    assert re.search(r"Exchange hashpartitioning\(date#\d+, merchant_id#\d+, currency#\d+, transaction_id#\d+", plan)
    assert "partial_sum" in plan


def test_card_rules_use_one_sort_and_no_range_frame(spark):
    from cardlake.plans.catalog import REGISTRY
    plan = REGISTRY["flag_all_rules"](spark, SMOKE)._jdf.queryExecution().executedPlan().toString()
    assert "RangeFrame, -" not in plan and "rangebetween" not in plan.lower()
    assert plan.count("Sort [") <= 1
