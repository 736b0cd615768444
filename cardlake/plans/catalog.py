"""Named queries over the driver's tables: ``name -> f(spark, sf_dir) -> DataFrame``.

Each query derives its input from ``events`` through the fixture views and
then runs the library's operators on it, so its work grows with the table.
Streaming queries write their input into the shared checkpoint folder, drain
it with ``availableNow`` and return what their sinks wrote.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.operators import layers, models, quality, rules
from cardlake.operators.card_rules import flag_all_rules
from cardlake.operators.parse import parse_payments
from cardlake.operators.routing import dead_letters, to_value
from cardlake.plans.compaction import compact, read_compacted
from cardlake.plans.fixture_params import (DLQ_TS, FRESHNESS_AS_OF, FRESHNESS_MAX_LAG_S,
                                           PROCESSED_AT, REPORT_DAY, RETENTION_AS_OF,
                                           RETENTION_DAYS)
from cardlake.plans.incremental import MARTS, refresh_models
from cardlake.plans.key_index import KeyIndex
from cardlake.plans.profiles import profile_load, read_profile
from cardlake.plans.reports import archive_partitions, export_report, read_report, retention_candidates
from cardlake.schemas import (BRONZE, CARD_RULE_COLUMNS, PARSED, RAW_FIELDS, SILVER,
                              WAREHOUSE_COLUMNS)
from cardlake.session import shared_path
from cardlake.sources import fixtures
from cardlake.sources.generations import read_generations
from cardlake.sources.lines import text_stream, write_lines
from cardlake.streaming.jobs import (await_all, read_warehouse, run_silver, run_warehouse,
                                     start_card_rules_ingest, start_ingest, start_routed_ingest,
                                     warehouse_writer)
from cardlake.streaming.sinks import drain

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


# ---- shared inputs -------------------------------------------------------------

def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """payments + the two stateless rules (bronze, 16 columns)."""
    return rules.flag_stateless(fixtures.payments(spark, sf_dir))


def bronze_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.flag_stateless(fixtures.payments_dirty(spark, sf_dir))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warehouse ``transactions`` built from the clean payments."""
    return layers.to_warehouse(layers.with_processed_at(bronze(spark, sf_dir), PROCESSED_AT))


def stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.stg_transactions(transactions(spark, sf_dir))


def unchecked_stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging over an unvalidated load of the dirty rows (so checks find things)."""
    raw = layers.to_warehouse(layers.with_processed_at(bronze_dirty(spark, sf_dir), PROCESSED_AT),
                              require_id=False)
    return models.stg_transactions(raw)


def parsed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return parse_payments(fixtures.raw_lines(spark, sf_dir), as_of=DLQ_TS)


def from_value(df: DataFrame, fields) -> DataFrame:
    """Fields read back out of the JSON ``value`` (plus ``key`` when present)."""
    cols = [F.get_json_object("value", f"$.{f}").alias(f) for f in fields]
    return df.select(*([F.col("key")] if "key" in df.columns else []), *cols)


def delivered(spark: SparkSession, name: str, lines: DataFrame) -> str:
    """Write payload lines as files into a fresh shared folder; return the folder."""
    root = shared_path(spark, name)
    write_lines(lines, f"{root}/in")
    return root


# ---- stateless rules and routing ---------------------------------------------------

@register("rule_high_amount")
def q_rule_high_amount(spark, sf_dir):
    p = fixtures.payments(spark, sf_dir)
    return rules.flag_high_amount(p).select("transaction_id", "amount", "rule_high_amount")


@register("rule_blacklist")
def q_rule_blacklist(spark, sf_dir):
    """Table form (join path): the blacklist as a literal table."""
    p = fixtures.payments(spark, sf_dir)
    return (rules.flag_blacklist(p, rules.blacklist_table(spark))
            .select("transaction_id", "merchant_id", "rule_blacklist"))


@register("flag_stateless")
def q_flag_stateless(spark, sf_dir):
    return bronze(spark, sf_dir)


@register("route_flagged")
def q_route_flagged(spark, sf_dir):
    return rules.route(bronze(spark, sf_dir))[1]


@register("route_clean")
def q_route_clean(spark, sf_dir):
    return rules.route(bronze(spark, sf_dir))[0]


# ---- per-card rules (payments_fast: one hour, so the rules fire) ---------------

def card_rules(spark, sf_dir):
    return flag_all_rules(fixtures.payments_fast(spark, sf_dir))


@register("rule_velocity")
def q_rule_velocity(spark, sf_dir):
    return card_rules(spark, sf_dir).select("transaction_id", "card_hash", "event_ts", "rule_velocity")


@register("rule_cross_border")
def q_rule_cross_border(spark, sf_dir):
    return card_rules(spark, sf_dir).select("transaction_id", "card_hash", "location", "rule_cross_border")


@register("rule_decline_rate")
def q_rule_decline_rate(spark, sf_dir):
    return card_rules(spark, sf_dir).select("transaction_id", "card_hash", "auth_result", "rule_decline_rate")


@register("flag_all_rules")
def q_flag_all_rules(spark, sf_dir):
    return card_rules(spark, sf_dir)


# ---- raw payloads, parse, dead letter ------------------------------------------

@register("src_raw_lines")
def q_src_raw_lines(spark, sf_dir):
    """Payloads delivered as text files, drained by a file stream (topic stand-in)."""
    root = delivered(spark, "src_raw_lines", fixtures.raw_lines(spark, sf_dir))
    out = drain(text_stream(spark, f"{root}/in"), f"{root}/out", f"{root}/chk")
    return out.select(F.get_json_object("value", "$.transaction_id").alias("transaction_id"),
                      (F.col("value") == "").alias("is_blank"))


@register("src_generations")
def q_src_generations(spark, sf_dir):
    """Files of two schema generations: the older ones have float amounts and no location."""
    root = shared_path(spark, "src_generations")
    p = fixtures.payments(spark, sf_dir)
    old = F.col("date") < F.lit("2024-01-15").cast("date")
    p.filter(old).withColumn("amount", F.col("amount").cast("float")).drop("location").write.parquet(f"{root}/1")
    p.filter(~old).write.parquet(f"{root}/2")
    return read_generations(spark, [f"{root}/1", f"{root}/2"], PARSED, required=["transaction_id"]).select(
        "transaction_id", "amount", "location", "mcc", "date")


@register("parse_payments")
def q_parse(spark, sf_dir):
    return parsed(spark, sf_dir)[0]


@register("invalid_payments")
def q_invalid(spark, sf_dir):
    return parsed(spark, sf_dir)[1].select("error_reason", "transaction_id", "card_hash", "amount")


@register("bronze_payments")
def q_bronze_payments(spark, sf_dir):
    return rules.flag_stateless(parsed(spark, sf_dir)[0])


@register("dlq_flagged")
def q_dlq_flagged(spark, sf_dir):
    flagged = rules.route(rules.flag_stateless(parsed(spark, sf_dir)[0]))[1]
    return from_value(to_value(flagged), ["transaction_id", "merchant_id", "fraud_reason"])


@register("dlq_envelope")
def q_dlq_envelope(spark, sf_dir):
    """All dead letters of the payloads: unparseable, flagged, undecided (one pass)."""
    letters = dead_letters(fixtures.raw_lines(spark, sf_dir), as_of=DLQ_TS)
    return from_value(letters, ["transaction_id", "error_reason"])


# ---- lake layers --------------------------------------------------------------------

@register("silver_payments")
def q_silver(spark, sf_dir):
    return layers.to_silver(bronze_dirty(spark, sf_dir), processed_at=PROCESSED_AT)


@register("warehouse_transactions")
def q_warehouse(spark, sf_dir):
    return layers.to_warehouse(layers.to_silver(bronze_dirty(spark, sf_dir), processed_at=PROCESSED_AT))


# ---- models -----------------------------------------------------------------------

@register("stg_transactions")
def q_stg(spark, sf_dir):
    return stg(spark, sf_dir)


@register("fact_transactions")
def q_fact(spark, sf_dir):
    return models.fact_transactions(stg(spark, sf_dir))


@register("fact_fraud_signals")
def q_signals(spark, sf_dir):
    return models.fact_fraud_signals(stg(spark, sf_dir))


@register("dim_merchants")
def q_dim_merchants(spark, sf_dir):
    return models.dim_merchants(stg(spark, sf_dir))


@register("dim_currency")
def q_dim_currency(spark, sf_dir):
    return models.dim_currency(stg(spark, sf_dir))


@register("dim_auth_results")
def q_dim_auth(spark, sf_dir):
    return models.dim_auth_results(stg(spark, sf_dir))


def _fact_mart(fn, exact: bool) -> Query:
    def q(spark, sf_dir):
        s = stg(spark, sf_dir)
        return fn(models.fact_transactions(s), models.dim_merchants(s), one_row_per_merchant=exact)
    return q


def _signal_mart(exact: bool) -> Query:
    def q(spark, sf_dir):
        s = stg(spark, sf_dir)
        return models.mart_fraud_rate(models.fact_fraud_signals(s), models.dim_merchants(s),
                                      one_row_per_merchant=exact)
    return q


for _exact, _sfx in ((False, ""), (True, "_exact")):
    register(f"mart_settlement_daily{_sfx}")(_fact_mart(models.mart_settlement_daily, _exact))
    register(f"mart_fraud_settlement_daily{_sfx}")(_fact_mart(models.mart_fraud_settlement_daily, _exact))
    register(f"mart_fraud_alerts{_sfx}")(_fact_mart(models.mart_fraud_alerts, _exact))
    register(f"mart_fraud_rate{_sfx}")(_signal_mart(_exact))


@register("mart_currency_volume")
def q_currency_volume(spark, sf_dir):
    s = stg(spark, sf_dir)
    return models.mart_currency_volume(models.fact_transactions(s), models.dim_currency(s))


@register("mart_channel_performance")
def q_channel(spark, sf_dir):
    s = stg(spark, sf_dir)
    return models.mart_channel_performance(models.fact_transactions(s), models.dim_merchants(s))


@register("mart_channel_performance_exact")
def q_channel_exact(spark, sf_dir):
    s = stg(spark, sf_dir)
    return models.mart_channel_performance_exact(s, models.dim_merchants(s))


# ---- data quality -----------------------------------------------------------------

@register("dq_not_null")
def q_dq_not_null(spark, sf_dir):
    checks = [("stg_transactions", "transaction_id"), ("fact_transactions", "transaction_id"),
              ("fact_transactions", "merchant_id"), ("fact_transactions", "amount"),
              ("fact_fraud_signals", "transaction_id")]
    return quality.null_counts(unchecked_stg(spark, sf_dir), checks)


@register("dq_unique_txn")
def q_dq_unique(spark, sf_dir):
    return quality.unique(models.fact_transactions(unchecked_stg(spark, sf_dir)), "transaction_id")


def in_three_loads(df: DataFrame) -> list[tuple[str, DataFrame]]:
    """Payments by arrival: cards of 0 to 7, the others, and those of 4 to b again."""
    card = F.substring("card_hash", 1, 1)
    return [("l1", df.filter(card < "8")), ("l2", df.filter((card >= "8") | card.isNull())),
            ("l3", df.filter(card.between("4", "b")))]


@register("dq_unique_incremental")
def q_dq_unique_incremental(spark, sf_dir):
    """Each load checked against all before it: its keys that now occur more than once."""
    index = KeyIndex(spark, shared_path(spark, "dq_unique_incremental"))
    out = []
    for name, load in in_three_loads(models.fact_transactions(unchecked_stg(spark, sf_dir))
                                     .select("transaction_id", "card_hash")):
        found = shared_path(spark, "repeated")
        index.repeated(load, name).select(F.lit(name).alias("load"), "transaction_id", "n").write.parquet(found)
        index.add(load, name)
        out.append(found)
    return spark.read.parquet(*out)


@register("dedup_backfill")
def q_dedup_backfill(spark, sf_dir):
    """Loads against the index of known ids: the third is a backfill of ids that are there."""
    index = KeyIndex(spark, shared_path(spark, "dedup_backfill"))
    out = []
    for name, load in in_three_loads(bronze_dirty(spark, sf_dir).select(
            "transaction_id", "card_hash", "amount", "event_ts")):
        found = shared_path(spark, "first_seen")
        (index.first_seen(load.filter("transaction_id IS NOT NULL"), name)
         .select(F.lit(name).alias("load"), "transaction_id", "card_hash").write.parquet(found))
        index.add(load, name)
        out.append(found)
    return spark.read.parquet(*out)


def dq_children(spark, sf_dir):
    """The unvalidated load with references that no dimension has: payments from
    India name a terminal instead of a merchant, or no currency at all where the
    code is 4111; cash withdrawals online have an unknown currency."""
    india = F.col("location") == "India"
    merchant = F.when(india, F.concat(F.lit("T"), F.col("mcc"))).otherwise(F.col("merchant_id"))
    currency = (F.when(india & (F.col("mcc") == "4111"), F.lit(None).cast("string"))
                .when((F.col("mcc") == "6011") & (F.col("channel") == "ECOM"), F.lit("XXX"))
                .otherwise(F.col("currency")))
    return unchecked_stg(spark, sf_dir).withColumns({"merchant_id": merchant, "currency": currency})


@register("dq_rel_merchant")
def q_dq_rel_merchant(spark, sf_dir):
    return quality.foreign_key(models.fact_transactions(dq_children(spark, sf_dir)), "merchant_id",
                               models.dim_merchants(stg(spark, sf_dir)), "merchant_id")


@register("dq_rel_currency")
def q_dq_rel_currency(spark, sf_dir):
    return quality.foreign_key(models.fact_transactions(dq_children(spark, sf_dir)), "currency",
                               models.dim_currency(stg(spark, sf_dir)), "currency_code")


@register("dq_rel_signal")
def q_dq_rel_signal(spark, sf_dir):
    """Signals of the unvalidated load against the facts of the validated one."""
    checked = models.stg_transactions(q_warehouse(spark, sf_dir))
    return quality.foreign_key(models.fact_fraud_signals(unchecked_stg(spark, sf_dir)), "transaction_id",
                               models.fact_transactions(checked), "transaction_id")


@register("dq_amount_non_negative")
def q_dq_amount(spark, sf_dir):
    return quality.amount_non_negative(models.fact_transactions(unchecked_stg(spark, sf_dir)))


@register("dq_valid_currency")
def q_dq_currency(spark, sf_dir):
    return quality.valid_currency(models.fact_transactions(dq_children(spark, sf_dir)),
                                  models.dim_currency(stg(spark, sf_dir)))


@register("dq_profile")
def q_dq_profile(spark, sf_dir):
    return quality.profile(unchecked_stg(spark, sf_dir), key="transaction_id")


@register("dq_profile_incremental")
def q_dq_profile_incremental(spark, sf_dir):
    """The profile out of the parts of three loads, one of them profiled twice."""
    root = shared_path(spark, "dq_profile_incremental")
    index = KeyIndex(spark, f"{root}/index")
    rows = unchecked_stg(spark, sf_dir)
    turn = F.pmod(F.crc32(F.coalesce("card_hash", F.lit(""))), F.lit(3))
    for number in (0, 1, 1, 2):
        profile_load(rows.filter(turn == number), f"l{number}", f"{root}/parts", index)
    return read_profile(spark, f"{root}/parts", distinct=False)


@register("dq_freshness")
def q_dq_freshness(spark, sf_dir):
    return quality.freshness(fixtures.payments(spark, sf_dir), FRESHNESS_AS_OF, FRESHNESS_MAX_LAG_S)


# ---- reports and retention --------------------------------------------------------

def _report(mart_key: str, prefix: str) -> Query:
    def q(spark, sf_dir):
        mart = REGISTRY[mart_key](spark, sf_dir)
        out = export_report(mart, REPORT_DAY, shared_path(spark, "reports"), prefix=prefix)
        return read_report(spark, out, mart.schema)
    return q


register("report_settlement_daily")(_report("mart_settlement_daily", "settlement"))
register("report_fraud_daily")(_report("mart_fraud_settlement_daily", "fraud"))


@register("retention_candidates")
def q_retention(spark, sf_dir):
    old = retention_candidates(bronze(spark, sf_dir), RETENTION_AS_OF, RETENTION_DAYS)
    return old.groupBy("date").agg(F.count(F.lit(1)).alias("row_count"))


@register("archive_days")
def q_archive(spark, sf_dir):
    """Two archive runs: the second brings late rows of a day that the first archived."""
    old = retention_candidates(bronze(spark, sf_dir), RETENTION_AS_OF, RETENTION_DAYS)
    late = (F.col("date") == F.lit("2024-01-03").cast("date")) & F.col("transaction_id").endswith("7")
    path = shared_path(spark, "archive")
    archive_partitions(old.filter(~late), path, "first")
    archive_partitions(old, path, "second")
    return spark.read.parquet(path).groupBy("date").agg(F.count(F.lit(1)).alias("row_count"),
                                                        F.countDistinct("transaction_id").alias("ids"))


# ---- streaming jobs -------------------------------------------------------------------

@register("stream_bronze")
def q_stream_bronze(spark, sf_dir):
    root = delivered(spark, "stream_bronze", fixtures.raw_lines(spark, sf_dir))
    await_all(start_ingest(text_stream(spark, f"{root}/in"), f"{root}/bronze", f"{root}/chk",
                           dlq_path=f"{root}/dlq", trigger="available_now", as_of=DLQ_TS))
    return spark.read.schema(BRONZE).parquet(f"{root}/bronze")


@register("stream_dlq")
def q_stream_dlq(spark, sf_dir):
    """Dead letter of the ingest job (flagged, undecided, unparseable), read back."""
    root = delivered(spark, "stream_dlq", fixtures.raw_lines(spark, sf_dir))
    await_all(start_ingest(text_stream(spark, f"{root}/in"), f"{root}/bronze", f"{root}/chk",
                           dlq_path=f"{root}/dlq", trigger="available_now", as_of=DLQ_TS))
    return from_value(spark.read.schema("key string, value string").parquet(f"{root}/dlq"),
                      ["transaction_id", "error_reason"])


@register("stream_routes")
def q_stream_routes(spark, sf_dir):
    """All three sinks of the routed ingest, read back with the sink name: every
    delivered line is in clean, in the dead letter, or (flagged) in both of its sinks."""
    root = delivered(spark, "stream_routes", fixtures.raw_lines(spark, sf_dir))
    await_all(start_routed_ingest(text_stream(spark, f"{root}/in"), f"{root}/clean", f"{root}/flagged",
                                  f"{root}/chk", dlq_path=f"{root}/dlq", trigger="available_now", as_of=DLQ_TS,
                                  one_pass=True))
    kept = ["transaction_id", "card_hash", "amount", "is_fraud"]
    clean = spark.read.schema(BRONZE).parquet(f"{root}/clean").select(
        F.lit("clean").alias("sink"), *kept, F.lit(None).cast("string").alias("error_reason"))
    flagged = spark.read.schema(BRONZE).parquet(f"{root}/flagged").select(
        F.lit("flagged").alias("sink"), *kept, F.lit(None).cast("string").alias("error_reason"))
    letters = from_value(spark.read.schema("key string, value string").parquet(f"{root}/dlq"),
                         [*kept, "error_reason"])
    letters = letters.select(F.lit("dead letter").alias("sink"), "transaction_id", "card_hash",
                             F.col("amount").cast("double").alias("amount"),
                             F.col("is_fraud").cast("boolean").alias("is_fraud"), "error_reason")
    return clean.unionByName(flagged).unionByName(letters)


@register("stream_silver")
def q_stream_silver(spark, sf_dir):
    root = shared_path(spark, "stream_silver")
    bronze_dirty(spark, sf_dir).write.partitionBy("date").parquet(f"{root}/bronze")
    run_silver(spark, f"{root}/bronze", f"{root}/silver", f"{root}/chk", processed_at=PROCESSED_AT)
    return spark.read.schema(SILVER).parquet(f"{root}/silver")


@register("stream_warehouse")
def q_stream_warehouse(spark, sf_dir):
    root = shared_path(spark, "stream_warehouse")
    silver = layers.to_silver(bronze_dirty(spark, sf_dir), processed_at=PROCESSED_AT)
    silver.write.partitionBy("date").parquet(f"{root}/silver")
    run_warehouse(spark, f"{root}/silver", f"{root}/chk", 
                  warehouse_writer(f"{root}/wh", checkpoint=f"{root}/chk"))
    return read_warehouse(spark, f"{root}/wh").select(*WAREHOUSE_COLUMNS)


@register("warehouse_compacted")
def q_warehouse_compacted(spark, sf_dir):
    """The warehouse in 50 loads, ten a day: six are packed, two more stay beside the
    part, and with the last two all are packed again where a day got rows of each."""
    path = f"{shared_path(spark, 'warehouse_compacted')}/wh"
    turn = F.pmod(F.crc32(F.col("transaction_id")), F.lit(10))
    number = F.coalesce(F.dayofmonth("date") % 5, F.lit(0)) + 5 * turn
    load = F.concat(F.lit("a1b2c3d4-"), F.lpad(number.cast("string"), 9, "0"))
    rows = q_warehouse(spark, sf_dir).select(*WAREHOUSE_COLUMNS)

    def deliver(turns):
        (rows.filter(turns).withColumn("load_id", load).hint("rebalance", "date")
         .write.mode("append").partitionBy("date", "load_id").parquet(path))
    deliver(turn < 6)
    compact(spark, path, max_parts=5)
    deliver(turn.between(6, 7))
    compact(spark, path, max_parts=5)
    deliver(turn >= 8)
    compact(spark, path, max_parts=4)
    return read_compacted(spark, path).select(*WAREHOUSE_COLUMNS)


def decided_rows(spark, path):
    return spark.read.parquet(path).select(*CARD_RULE_COLUMNS, "is_fraud", "fraud_reason")


@register("stream_card_rules")
def q_stream_card_rules(spark, sf_dir):
    """payments_fast delivered in four 15-minute slices, one drain per slice
    with the same checkpoint: later slices look back into earlier ones."""
    root = shared_path(spark, "stream_card_rules")
    fast = fixtures.payments_fast(spark, sf_dir)
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    for i in range(4):
        lo = start + F.expr(f"INTERVAL {15 * i} MINUTES")
        hi = start + F.expr(f"INTERVAL {15 * (i + 1)} MINUTES")
        cond = (F.col("event_ts") >= lo) & (F.col("event_ts") < hi) if i < 3 else (F.col("event_ts") >= lo)
        fast.filter(cond).write.mode("append").parquet(f"{root}/in")
        await_all(start_card_rules_ingest(spark.readStream.schema(PARSED).parquet(f"{root}/in"),
                                          f"{root}/decided", f"{root}/chk", trigger="available_now",
                                          payloads=False))
    return decided_rows(spark, f"{root}/decided")


@register("stream_card_rules_ingest")
def q_stream_card_rules_ingest(spark, sf_dir):
    """Ingest from JSON payloads of payments_fast: decided rows read back."""
    payloads = fixtures.payments_fast(spark, sf_dir).select(F.to_json(F.struct(*RAW_FIELDS)).alias("value"))
    root = delivered(spark, "stream_card_rules_ingest", payloads)
    await_all(start_card_rules_ingest(text_stream(spark, f"{root}/in"), f"{root}/decided", f"{root}/chk",
                                      dlq_path=f"{root}/dlq", trigger="available_now", as_of=DLQ_TS))
    return decided_rows(spark, f"{root}/decided")


def _outcomes(spark, root, undecided):
    """Decided rows and the letters of undecided ones, as (transaction_id, outcome, is_fraud, fraud_reason)."""
    letters = from_value(spark.read.parquet(f"{root}/dlq").select("key", "value"),
                         ["transaction_id", "error_reason"]).filter(undecided)
    return (decided_rows(spark, f"{root}/decided")
            .select("transaction_id", F.lit("decided").alias("outcome"), "is_fraud", "fraud_reason")
            .unionByName(letters.select("transaction_id", F.col("error_reason").alias("outcome"),
                                        F.lit(None).cast("boolean").alias("is_fraud"),
                                        F.lit(None).cast("string").alias("fraud_reason"))))


@register("stream_card_rules_late")
def q_stream_card_rules_late(spark, sf_dir):
    """Half of the cards are delivered in a second drain: their rows that are over
    15 minutes behind the first drain's newest are letters, the others decided.
    Every payment is in one of the two, decided or ``LATE_EVENT``."""
    fast = fixtures.payments_fast(spark, sf_dir)
    root = shared_path(spark, "stream_card_rules_late")
    second = F.col("card_hash") >= "8"
    for part in (~second, second):
        fast.filter(part).select(F.to_json(F.struct(*RAW_FIELDS)).alias("value")) \
            .write.mode("append").text(f"{root}/in")
        await_all(start_card_rules_ingest(text_stream(spark, f"{root}/in"), f"{root}/decided", f"{root}/chk",
                                          dlq_path=f"{root}/dlq", trigger="available_now", as_of=DLQ_TS, support=1))
    return _outcomes(spark, root, "error_reason = 'LATE_EVENT'")


@register("stream_card_rules_future")
def q_stream_card_rules_future(spark, sf_dir):
    """Wrongly dated payments in the first of two drains: copies dated ten years ahead,
    and copies of one card dated two hours ahead.  The former are letters of their own
    kind; neither makes any other payment late or cuts what rules look back on."""
    fast = fixtures.payments_fast(spark, sf_dir)
    root = shared_path(spark, "stream_card_rules_future")
    middle = F.lit("2024-01-01 00:30:00").cast("timestamp")
    first, second = fast.filter(F.col("event_ts") < middle), fast.filter(F.col("event_ts") >= middle)
    card = fast.agg(F.min("card_hash")).first()[0]

    def dated(rows, mark, ahead):
        ts = F.col("event_ts") + F.expr(f"INTERVAL {ahead}")
        return (rows.withColumn("transaction_id", F.concat("transaction_id", F.lit(mark))).withColumn("event_ts", ts)
                .withColumn("ts_event", F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), fixtures.TS_TEXT_FORMAT)))
    wrong = dated(first.filter(F.col("transaction_id").endswith("50")), "-Y", "10 YEARS").unionByName(
        dated(first.filter(F.col("card_hash") == card), "-H", "2 HOURS"))
    for part in (first.unionByName(wrong), second):
        part.select(F.to_json(F.struct(*RAW_FIELDS)).alias("value")).write.mode("append").text(f"{root}/in")
        await_all(start_card_rules_ingest(text_stream(spark, f"{root}/in"), f"{root}/decided", f"{root}/chk",
                                          dlq_path=f"{root}/dlq", trigger="available_now", as_of=DLQ_TS))
    return _outcomes(spark, root, "error_reason in ('LATE_EVENT', 'FUTURE_EVENT')")


@register("stream_blacklist_table")
def q_stream_blacklist(spark, sf_dir):
    """Stream joined to the static blacklist table."""
    root = shared_path(spark, "stream_blacklist")
    fixtures.payments(spark, sf_dir).write.parquet(f"{root}/in")
    stream = rules.flag_blacklist(spark.readStream.schema(PARSED).parquet(f"{root}/in"),
                                  rules.blacklist_table(spark))
    return drain(stream.select("transaction_id", "merchant_id", "rule_blacklist"), f"{root}/out", f"{root}/chk")


@register("stream_silver_late")
def q_stream_silver_late(spark, sf_dir):
    """Late file: payments before 2024-01-03 delivered after all others.  The
    second drain (same checkpoint) finds them more than 24 h behind the
    watermark, so silver drops them (late data)."""
    root = shared_path(spark, "stream_silver_late")
    b = bronze(spark, sf_dir)
    late = F.col("event_ts") < F.lit("2024-01-03 00:00:00").cast("timestamp")
    b.filter(~late).write.partitionBy("date").parquet(f"{root}/bronze")
    run_silver(spark, f"{root}/bronze", f"{root}/silver", f"{root}/chk", processed_at=PROCESSED_AT)
    b.filter(late).write.mode("append").partitionBy("date").parquet(f"{root}/bronze")
    run_silver(spark, f"{root}/bronze", f"{root}/silver", f"{root}/chk", processed_at=PROCESSED_AT)
    return spark.read.schema(SILVER).parquet(f"{root}/silver")


# ---- incremental model refresh (two rounds) ----------------------------------------

def _incremental(mart: str) -> Query:
    """The warehouse arrives in two rounds (before / from 2024-01-15, plus a late
    row set for an early day in round two); after each round the models are
    refreshed incrementally.  Returns ``mart`` as stored after round two."""
    def q(spark, sf_dir):
        wh = transactions(spark, sf_dir)
        d = F.col("date")
        cut = F.lit("2024-01-15").cast("date")
        late = (d == F.lit("2024-01-03").cast("date")) & F.col("transaction_id").endswith("3")
        out = shared_path(spark, f"incremental_{mart}")
        refresh_models(wh.filter((d < cut) & ~late), out, marts=[mart])
        second_days = [str(r[0]) for r in wh.filter((d >= cut) | late).select("date").distinct().collect()]
        return refresh_models(wh, out, days=second_days, marts=[mart])[mart]
    return q


for _mart in MARTS:
    register(f"{_mart}_incremental")(_incremental(_mart))
