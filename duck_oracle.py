"""DuckDB oracle SQL for the registered queries.

Each entry is a self-contained statement over the pre-registered views
(``events`` ...).  The fixture views are re-stated here in plain SQL (see
fan-out joins computed row by row, while the Spark side uses the
aggregate-then-scale plan: the two are independent formulations.
"""

from __future__ import annotations

BASE = 1704067200000000
PROCESSED_AT = "TIMESTAMP '2024-02-01 00:00:00'"
MONEY = "DECIMAL(38,2)"


def _events(scale: int) -> str:
    return f"""
  SELECT event_id, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         make_timestamp({BASE} + (epoch_us(ts) - {BASE}) // {scale}) AS event_ts
  FROM events"""


def _payments(src: str) -> str:
    return f"""
  SELECT event_id,
         'TXN' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS transaction_id,
         strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS ts_event,
         sha1('card-' || CAST(user_id AS VARCHAR)) AS card_hash,
         CASE event_id % 40 WHEN 0 THEN 'M1001' WHEN 1 THEN 'M2002' WHEN 2 THEN 'M9999'
              ELSE 'M' || CAST(1000 + event_id % 40 AS VARCHAR) END AS merchant_id,
         round(value * 100, 2) AS amount,
         CASE k % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' WHEN 3 THEN 'INR' END AS currency,
         CASE event_type WHEN 'click' THEN '5411' WHEN 'view' THEN '5812' WHEN 'purchase' THEN '5999'
              WHEN 'signup' THEN '4111' WHEN 'error' THEN '6011' END AS mcc,
         CASE WHEN k % 2 = 0 THEN 'POS' ELSE 'ECOM' END AS channel,
         CASE WHEN event_type IN ('error', 'signup') THEN 'DECLINED' ELSE 'APPROVED' END AS auth_result,
         CASE WHEN k >= 98 THEN 'India' WHEN user_id % 2 = 0 THEN 'USA' ELSE 'UK' END AS location,
         event_ts,
         CAST(event_ts AS DATE) AS date
  FROM {src}"""


def _flags(src: str) -> str:
    return f"""
  SELECT *, (rule_high_amount OR rule_blacklist) AS is_fraud,
         concat_ws(',', CASE WHEN rule_high_amount THEN 'HIGH_AMOUNT' END,
                        CASE WHEN rule_blacklist THEN 'BLACKLISTED_MERCHANT' END) AS fraud_reason
  FROM (SELECT *, amount > 10000 AS rule_high_amount,
               coalesce(merchant_id IN ('M1001', 'M2002', 'M9999'), false) AS rule_blacklist
        FROM {src})"""


def _dirty(src: str) -> str:
    return f"""
  SELECT event_id,
         CASE WHEN event_id % 101 = 0 THEN NULL ELSE transaction_id END AS transaction_id,
         ts_event, card_hash, merchant_id,
         CASE WHEN event_id % 103 = 0 THEN NULL WHEN event_id % 97 = 0 THEN -amount ELSE amount END + (c.copy - 1) AS amount,
         currency, mcc, channel, auth_result, location, event_ts, date, c.copy AS copy
  FROM {src}, (SELECT unnest([1, 2]) AS copy) c
  WHERE c.copy = 1 OR {src}.event_id % 50 = 0"""


BRONZE_COLS = ("merchant_id, transaction_id, ts_event, card_hash, amount, currency, mcc, channel, "
               "auth_result, location, event_ts, date, rule_high_amount, rule_blacklist, is_fraud, fraud_reason")
WAREHOUSE_SELECT = ("transaction_id, ts_event, card_hash, merchant_id, CAST(amount AS DECIMAL(18,2)) AS amount, "
                    "currency, mcc, channel, auth_result, location, event_ts, rule_high_amount, "
                    "rule_blacklist, is_fraud, fraud_reason, processed_at, date")
STG_COLS = ("merchant_id, transaction_id, ts_event, card_hash, amount, currency, mcc, channel, "
            "auth_result, location, event_ts, rule_high_amount, rule_blacklist, is_fraud, "
            "fraud_reason, processed_at, date")
FACT_COLS = ("transaction_id, merchant_id, amount, currency, event_ts, card_hash, auth_result, "
             "is_fraud, fraud_reason, rule_high_amount, rule_blacklist, processed_at, date")
SIGNAL_COLS = "date, transaction_id, merchant_id, is_fraud, fraud_reason, rule_high_amount, rule_blacklist"


def _card_rules(src: str = "payments_fast") -> str:
    """Per-card rules by plain frames (payments_fast has no equal times per card)."""
    return f"""
  SELECT transaction_id, ts_event, card_hash, merchant_id, amount, currency, mcc, channel,
         auth_result, location, event_ts, date AS event_date, rule_high_amount, rule_blacklist,
         rule_velocity, rule_cross_border, rule_decline_rate,
         (rule_high_amount OR rule_blacklist OR rule_velocity OR rule_cross_border OR rule_decline_rate) AS is_fraud,
         concat_ws(',', CASE WHEN rule_high_amount THEN 'HIGH_AMOUNT' END,
                        CASE WHEN rule_blacklist THEN 'BLACKLISTED_MERCHANT' END,
                        CASE WHEN rule_velocity THEN 'VELOCITY' END,
                        CASE WHEN rule_cross_border THEN 'CROSS_BORDER' END,
                        CASE WHEN rule_decline_rate THEN 'DECLINE_RATE' END) AS fraud_reason
  FROM (
    SELECT *, amount > 10000 AS rule_high_amount,
           coalesce(merchant_id IN ('M1001', 'M2002', 'M9999'), false) AS rule_blacklist,
           count(*) OVER (PARTITION BY card_hash ORDER BY epoch_us(event_ts)
                          RANGE BETWEEN 60000000 PRECEDING AND CURRENT ROW) > 5 AS rule_velocity,
           count(DISTINCT coalesce(location, chr(0))) OVER (PARTITION BY card_hash ORDER BY epoch_us(event_ts)
                          RANGE BETWEEN 600000000 PRECEDING AND CURRENT ROW) > 1 AS rule_cross_border,
           (count(*) OVER (PARTITION BY card_hash ORDER BY epoch_us(event_ts)
                           RANGE BETWEEN 600000000 PRECEDING AND CURRENT ROW) >= 10
            AND sum(CASE WHEN auth_result = 'DECLINED' THEN 1 ELSE 0 END)
                  OVER (PARTITION BY card_hash ORDER BY epoch_us(event_ts)
                        ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) > 5) AS rule_decline_rate
    FROM {src})"""


def with_base(body: str) -> str:
    """Prefix the fixture CTEs (clean / fast / dirty payments, models)."""
    if body.lstrip().upper().startswith("WITH"):
        body = f"SELECT * FROM ({body})"
    return f"""WITH
ev1 AS ({_events(1)}),
ev720 AS ({_events(720)}),
payments AS ({_payments('ev1')}),
payments_fast AS ({_payments('ev720')}),
payments_dirty AS ({_dirty('payments')}),
bronze AS (SELECT {BRONZE_COLS}, event_id FROM ({_flags('payments')})),
bronze_dirty AS (SELECT {BRONZE_COLS}, event_id, copy FROM ({_flags('payments_dirty')})),
transactions AS (SELECT {WAREHOUSE_SELECT} FROM (SELECT *, {PROCESSED_AT} AS processed_at FROM bronze)
                 WHERE transaction_id IS NOT NULL),
stg AS (SELECT {STG_COLS} FROM transactions),
fact AS (SELECT {FACT_COLS} FROM stg),
signals AS (SELECT {SIGNAL_COLS} FROM stg),
dim_merchants AS (SELECT DISTINCT merchant_id, location, mcc, channel FROM stg),
dim_currency AS (SELECT DISTINCT currency AS currency_code FROM stg),
dim_auth AS (SELECT DISTINCT auth_result FROM stg),
unchecked AS (SELECT {STG_COLS} FROM (SELECT {WAREHOUSE_SELECT} FROM
              (SELECT *, {PROCESSED_AT} AS processed_at FROM bronze_dirty))),
ufact AS (SELECT {FACT_COLS} FROM unchecked),
usignals AS (SELECT {SIGNAL_COLS} FROM unchecked),
lines AS (SELECT *, CASE WHEN event_id % 83 = 0 THEN 'EMPTY_PAYLOAD' WHEN event_id % 89 = 0 THEN 'INVALID_JSON'
                         WHEN transaction_id IS NULL THEN 'MISSING_ID' END AS error_reason
          FROM bronze_dirty),
uchild AS (SELECT * REPLACE (
    CASE WHEN location = 'India' THEN 'T' || mcc ELSE merchant_id END AS merchant_id,
    CASE WHEN location = 'India' AND mcc = '4111' THEN NULL WHEN mcc = '6011' AND channel = 'ECOM' THEN 'XXX'
         ELSE currency END AS currency) FROM unchecked),
cfact AS (SELECT {FACT_COLS} FROM uchild),
card_rules AS ({_card_rules()})
{body}"""


def _fanned(exact: bool) -> str:
    """Fact rows paired with every matching merchant-dimension row.

    As written, the marts join facts to a dimension holding one row per
    (merchant, location, mcc, channel); this CTE body materialises exactly
    those pairs (or one pair per fact row for the exact variants), so the
    aggregates below see the repeated rows row by row.
    """
    dim = "(SELECT DISTINCT merchant_id, NULL AS channel FROM dim_merchants)" if exact else "dim_merchants"
    return f"""SELECT x.*, y.channel AS dim_channel FROM fact x, {dim} y WHERE y.merchant_id = x.merchant_id"""


def _marts(exact: bool) -> dict[str, str]:
    sfx = "_exact" if exact else ""
    pairs = _fanned(exact)
    signal_dim = "(SELECT DISTINCT merchant_id FROM dim_merchants)" if exact else "dim_merchants"
    return {
        f"mart_settlement_daily{sfx}": f"""
WITH kept AS (SELECT * FROM ({pairs}) WHERE NOT is_fraud AND auth_result = 'APPROVED'),
     per_day AS (SELECT date, merchant_id, currency, sum(amount) AS money, count(DISTINCT transaction_id) AS n
                 FROM kept GROUP BY date, merchant_id, currency)
SELECT date, merchant_id, currency, CAST(money AS {MONEY}) AS total_amount, CAST(n AS BIGINT) AS transaction_count,
       CAST(round(money * 0.02, 2) AS {MONEY}) AS fees,
       CAST(round(money - round(money * 0.02, 2), 2) AS {MONEY}) AS total_settlement
FROM per_day""",
        f"mart_fraud_settlement_daily{sfx}": f"""
WITH pairs AS ({pairs})
SELECT date, merchant_id,
       CAST(sum(amount) AS {MONEY}) AS total_amount,
       CAST(count(DISTINCT transaction_id) AS BIGINT) AS transaction_count,
       CAST(count(*) FILTER (WHERE is_fraud) AS BIGINT) AS fraud_count,
       CAST(coalesce(sum(amount) FILTER (WHERE is_fraud), 0) AS {MONEY}) AS fraud_amount
FROM pairs GROUP BY date, merchant_id""",
        f"mart_fraud_rate{sfx}": f"""
WITH pairs AS (SELECT s.* FROM signals s, {signal_dim} y WHERE y.merchant_id = s.merchant_id),
     counted AS (SELECT date, merchant_id, count(*) AS total, count(*) FILTER (WHERE is_fraud) AS bad
                 FROM pairs GROUP BY date, merchant_id)
SELECT date, merchant_id, CAST(total AS BIGINT) AS total_transactions, CAST(bad AS BIGINT) AS fraud_transactions,
       CAST((20000 * bad + total) // (2 * total) AS DOUBLE) / 100 AS fraud_rate_pct
FROM counted""",
        f"mart_fraud_alerts{sfx}": f"""
WITH pairs AS ({pairs})
SELECT date, transaction_id, merchant_id, amount, currency, is_fraud, fraud_reason,
       rule_high_amount, rule_blacklist
FROM pairs WHERE is_fraud""",
    }


STG_COL_LIST = [c.strip() for c in STG_COLS.split(",")]


def _profile_sql() -> str:
    parts = []
    for c in STG_COL_LIST:
        parts.append(f"""SELECT '{c}' AS column_name, count(*) AS row_count,
       count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM unchecked""")
    body = " UNION ALL ".join(parts)
    return f"""
SELECT column_name, CAST(row_count AS BIGINT) AS row_count, CAST(null_count AS BIGINT) AS null_count,
       CAST((20000 * null_count + row_count) // (2 * row_count) AS DOUBLE) / 100 AS null_pct,
       CAST((SELECT count(transaction_id) - count(DISTINCT transaction_id) FROM unchecked) AS BIGINT)
         AS duplicate_keys
FROM ({body})"""


def queries() -> dict[str, str]:
    q: dict[str, str] = {
        "rule_high_amount": "SELECT transaction_id, amount, amount > 10000 AS rule_high_amount FROM payments",
        "rule_blacklist": "SELECT transaction_id, merchant_id, rule_blacklist FROM bronze",
        "flag_stateless": f"SELECT {BRONZE_COLS} FROM bronze",
        "route_flagged": f"SELECT {BRONZE_COLS} FROM bronze WHERE is_fraud",
        "route_clean": f"SELECT {BRONZE_COLS} FROM bronze WHERE NOT is_fraud",
        "stg_transactions": "SELECT * FROM stg",
        "fact_transactions": "SELECT * FROM fact",
        "fact_fraud_signals": "SELECT * FROM signals",
        "dim_merchants": "SELECT * FROM dim_merchants",
        "dim_currency": "SELECT * FROM dim_currency",
        "dim_auth_results": "SELECT * FROM dim_auth",
        "mart_currency_volume": f"""
WITH known AS (SELECT x.*, c.currency_code FROM fact x, dim_currency c WHERE c.currency_code = x.currency)
SELECT date, currency, currency_code, CAST(sum(amount) AS {MONEY}) AS total_amount,
       CAST(count(DISTINCT transaction_id) AS BIGINT) AS transaction_count
FROM known GROUP BY ALL""",
        "mart_channel_performance": f"""
WITH pairs AS ({_fanned(False)})
SELECT date, dim_channel AS channel, CAST(count(DISTINCT transaction_id) AS BIGINT) AS transaction_count,
       CAST(sum(amount) AS {MONEY}) AS total_amount,
       CAST(count(*) FILTER (WHERE is_fraud) AS BIGINT) AS fraud_count
FROM pairs GROUP BY date, dim_channel""",
        "mart_channel_performance_exact": f"""
SELECT s.date, s.channel, CAST(count(DISTINCT s.transaction_id) AS BIGINT) AS transaction_count,
       CAST(sum(s.amount) AS {MONEY}) AS total_amount,
       CAST(sum(CASE WHEN s.is_fraud THEN 1 ELSE 0 END) AS BIGINT) AS fraud_count
FROM stg s WHERE s.merchant_id IN (SELECT merchant_id FROM dim_merchants)
GROUP BY s.date, s.channel""",
        "warehouse_transactions": f"""
SELECT {WAREHOUSE_SELECT} FROM (
  SELECT *, {PROCESSED_AT} AS processed_at,
         row_number() OVER (PARTITION BY transaction_id, event_ts ORDER BY copy) AS rn
  FROM bronze_dirty)
WHERE rn = 1 AND amount >= 0 AND transaction_id IS NOT NULL""",
    }
    q["flag_all_rules"] = "SELECT * FROM card_rules"
    q["src_raw_lines"] = """SELECT CASE WHEN event_id % 83 = 0 OR event_id % 89 = 0 THEN NULL ELSE transaction_id END
                                   AS transaction_id, event_id % 83 = 0 AS is_blank FROM lines"""
    q["parse_payments"] = """SELECT transaction_id, ts_event, card_hash, merchant_id, amount, currency, mcc, channel,
                                    auth_result, location, event_ts, date FROM lines WHERE error_reason IS NULL"""
    q["invalid_payments"] = """SELECT error_reason, CAST(NULL AS VARCHAR) AS transaction_id,
                                      CASE WHEN error_reason = 'MISSING_ID' THEN card_hash END AS card_hash,
                                      CASE WHEN error_reason = 'MISSING_ID' THEN amount END AS amount
                               FROM lines WHERE error_reason IS NOT NULL"""
    q["bronze_payments"] = f"SELECT {BRONZE_COLS} FROM lines WHERE error_reason IS NULL"
    q["dlq_flagged"] = """SELECT transaction_id, merchant_id, fraud_reason FROM lines
                          WHERE error_reason IS NULL AND is_fraud"""
    q["dlq_envelope"] = """
SELECT card_hash AS key, transaction_id, 'FRAUD_DETECTED' AS error_reason FROM lines
WHERE error_reason IS NULL AND is_fraud
UNION ALL
SELECT card_hash AS key, transaction_id, 'MISSING_AMOUNT' FROM lines
WHERE error_reason IS NULL AND is_fraud IS NULL
UNION ALL
SELECT CASE WHEN error_reason = 'MISSING_ID' THEN card_hash END, NULL, error_reason FROM lines
WHERE error_reason IS NOT NULL"""
    q["silver_payments"] = f"""
SELECT {BRONZE_COLS}, processed_at FROM (
  SELECT *, {PROCESSED_AT} AS processed_at,
         row_number() OVER (PARTITION BY transaction_id, event_ts ORDER BY copy) AS rn
  FROM bronze_dirty)
WHERE rn = 1 AND amount >= 0"""
    q["rule_velocity"] = "SELECT transaction_id, card_hash, event_ts, rule_velocity FROM card_rules"
    q["rule_cross_border"] = "SELECT transaction_id, card_hash, location, rule_cross_border FROM card_rules"
    q["rule_decline_rate"] = "SELECT transaction_id, card_hash, auth_result, rule_decline_rate FROM card_rules"
    q["dq_not_null"] = """
SELECT * FROM (
  SELECT 'stg_transactions' AS model, 'transaction_id' AS column_name,
         CAST(count(*) FILTER (WHERE transaction_id IS NULL) AS BIGINT) AS failures FROM unchecked
  UNION ALL SELECT 'fact_transactions', 'transaction_id', count(*) FILTER (WHERE transaction_id IS NULL) FROM ufact
  UNION ALL SELECT 'fact_transactions', 'merchant_id', count(*) FILTER (WHERE merchant_id IS NULL) FROM ufact
  UNION ALL SELECT 'fact_transactions', 'amount', count(*) FILTER (WHERE amount IS NULL) FROM ufact
  UNION ALL SELECT 'fact_fraud_signals', 'transaction_id', count(*) FILTER (WHERE transaction_id IS NULL)
            FROM usignals)"""
    q["dq_unique_txn"] = """SELECT transaction_id, count(*) AS n FROM ufact WHERE transaction_id IS NOT NULL
                            GROUP BY transaction_id HAVING count(*) > 1"""
    card = "substr(card_hash, 1, 1)"
    loads = [("l1", f"{card} < '8'"), ("l2", f"({card} >= '8' OR card_hash IS NULL)"),
             ("l3", f"{card} BETWEEN '4' AND 'b'")]
    rows = [" UNION ALL ".join(f"SELECT '{n}' AS load, transaction_id, card_hash FROM {src} "
                               f"WHERE transaction_id IS NOT NULL AND {w}" for n, w in loads)
            for src in ("ufact", "bronze_dirty")]
    q["dq_unique_incremental"] = f"""
SELECT l.load, l.transaction_id, count(*) AS n
FROM (SELECT DISTINCT load, transaction_id FROM ({rows[0]})) l
JOIN ({rows[0]}) r ON r.transaction_id = l.transaction_id AND r.load <= l.load
GROUP BY l.load, l.transaction_id HAVING count(*) > 1"""
    q["dedup_backfill"] = f"""
SELECT load, transaction_id, min(card_hash) AS card_hash FROM ({rows[1]}) r
WHERE load = (SELECT min(load) FROM ({rows[1]}) f WHERE f.transaction_id = r.transaction_id)
GROUP BY load, transaction_id"""
    q["dq_rel_merchant"] = """SELECT f.* FROM cfact f LEFT JOIN (SELECT DISTINCT merchant_id FROM dim_merchants) d
                              ON f.merchant_id = d.merchant_id
                              WHERE f.merchant_id IS NOT NULL AND d.merchant_id IS NULL"""
    q["dq_rel_currency"] = """SELECT f.* FROM cfact f LEFT JOIN dim_currency d ON f.currency = d.currency_code
                              WHERE f.currency IS NOT NULL AND d.currency_code IS NULL"""
    q["dq_rel_signal"] = f"""SELECT s.* FROM usignals s LEFT JOIN
                              (SELECT DISTINCT transaction_id FROM ({q["warehouse_transactions"]})) f
                              ON s.transaction_id = f.transaction_id
                              WHERE s.transaction_id IS NOT NULL AND f.transaction_id IS NULL"""
    q["dq_amount_non_negative"] = "SELECT * FROM ufact WHERE amount < 0"
    q["dq_valid_currency"] = """SELECT *, CAST(NULL AS VARCHAR) AS currency_code FROM cfact
                                WHERE currency IS NULL
                                   OR currency NOT IN (SELECT currency_code FROM dim_currency
                                                       WHERE currency_code IS NOT NULL)"""
    q["dq_profile"] = _profile_sql()
    q["dq_profile_incremental"] = q["dq_profile"]
    q["dq_freshness"] = """
SELECT max_event_ts, TIMESTAMP '2024-01-31 00:30:00' AS as_of,
       CAST(epoch_us(TIMESTAMP '2024-01-31 00:30:00') - epoch_us(max_event_ts) AS DOUBLE) / 1000000 AS lag_seconds,
       coalesce((epoch_us(TIMESTAMP '2024-01-31 00:30:00') - epoch_us(max_event_ts)) / 1000000 > 3600, true) AS is_stale
FROM (SELECT max(event_ts) AS max_event_ts FROM payments)"""
    q["report_settlement_daily"] = "SELECT * FROM (" + _marts(False)["mart_settlement_daily"] + ") WHERE date = DATE '2024-01-15'"
    q["report_fraud_daily"] = "SELECT * FROM (" + _marts(False)["mart_fraud_settlement_daily"] + ") WHERE date = DATE '2024-01-15'"
    q["retention_candidates"] = """SELECT date, count(*) AS row_count FROM bronze
                                   WHERE date < DATE '2024-02-15' - INTERVAL 30 DAY GROUP BY date"""
    q["src_generations"] = """
SELECT transaction_id, CASE WHEN date < DATE '2024-01-15' THEN CAST(CAST(amount AS FLOAT) AS DOUBLE) ELSE amount END AS amount,
       CASE WHEN date >= DATE '2024-01-15' THEN location END AS location, mcc, date FROM payments"""
    q["stream_bronze"] = q["bronze_payments"]
    q["stream_silver"] = q["silver_payments"]
    q["stream_silver_late"] = f"""SELECT {BRONZE_COLS}, {PROCESSED_AT} AS processed_at FROM bronze
                                  WHERE event_ts >= TIMESTAMP '2024-01-03 00:00:00'"""
    q["stream_warehouse"] = q["warehouse_transactions"]
    q["warehouse_compacted"] = q["warehouse_transactions"]
    q["stream_card_rules"] = q["flag_all_rules"]
    q["stream_card_rules_ingest"] = q["flag_all_rules"]
    q["stream_card_rules_late"] = f"""
WITH newest AS (SELECT max(event_ts) AS t FROM payments_fast WHERE card_hash < '8'),
     second AS (SELECT p.* FROM payments_fast p, newest WHERE card_hash >= '8' AND event_ts >= t - INTERVAL 15 MINUTE)
SELECT transaction_id, 'decided' AS outcome, is_fraud, fraud_reason FROM card_rules WHERE card_hash < '8'
UNION ALL SELECT transaction_id, 'decided', is_fraud, fraud_reason FROM ({_card_rules("second")})
UNION ALL SELECT transaction_id, 'LATE_EVENT', NULL, NULL FROM payments_fast, newest
          WHERE card_hash >= '8' AND event_ts < t - INTERVAL 15 MINUTE"""
    q["stream_card_rules_future"] = f"""
WITH first AS (SELECT * FROM payments_fast WHERE event_ts < TIMESTAMP '2024-01-01 00:30:00'),
     ahead AS (SELECT * REPLACE (transaction_id || '-H' AS transaction_id, event_ts + INTERVAL 2 HOUR AS event_ts)
               FROM first WHERE card_hash = (SELECT min(card_hash) FROM payments_fast)),
     every AS (SELECT * FROM payments_fast UNION ALL SELECT * FROM ahead)
SELECT transaction_id, 'decided' AS outcome, is_fraud, fraud_reason FROM ({_card_rules("every")})
UNION ALL SELECT transaction_id || '-Y', 'FUTURE_EVENT', NULL, NULL FROM first WHERE transaction_id LIKE '%50'"""
    q["stream_blacklist_table"] = q["rule_blacklist"]
    q["archive_days"] = """SELECT date, count(*) AS row_count, count(DISTINCT transaction_id) AS ids FROM bronze
                           WHERE date < DATE '2024-02-15' - INTERVAL 30 DAY GROUP BY date"""
    q["stream_dlq"] = q["dlq_envelope"]
    q["stream_routes"] = """
SELECT CASE WHEN is_fraud THEN 'flagged' ELSE 'clean' END AS sink, transaction_id, card_hash, amount, is_fraud,
       CAST(NULL AS VARCHAR) AS error_reason
FROM lines WHERE error_reason IS NULL AND is_fraud IS NOT NULL
UNION ALL
SELECT 'dead letter', transaction_id, card_hash, amount, is_fraud,
       CASE WHEN is_fraud THEN 'FRAUD_DETECTED' ELSE 'MISSING_AMOUNT' END
FROM lines WHERE error_reason IS NULL AND coalesce(is_fraud, true)
UNION ALL
SELECT 'dead letter', NULL, CASE WHEN error_reason = 'MISSING_ID' THEN card_hash END,
       CASE WHEN error_reason = 'MISSING_ID' THEN amount END, NULL, error_reason
FROM lines WHERE error_reason IS NOT NULL"""
    q.update(_marts(False))
    q.update(_marts(True))
    for mart in ("mart_settlement_daily", "mart_fraud_settlement_daily", "mart_fraud_rate", "mart_currency_volume",
                 "mart_channel_performance", "mart_fraud_alerts"):
        q[f"{mart}_incremental"] = q[mart]
    return {k: with_base(v) for k, v in q.items()}
