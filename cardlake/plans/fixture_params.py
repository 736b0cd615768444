"""Fixed parameters of the registered fixture queries.

Times that the reference takes from the clock (processed_at, dlq_ts, the
report day) are parameters here, so results are reproducible.
"""

PROCESSED_AT = "2024-02-01 00:00:00"
DLQ_TS = "2024-02-01 00:00:00"
REPORT_DAY = "2024-01-15"
FRESHNESS_AS_OF = "2024-01-31 00:30:00"
FRESHNESS_MAX_LAG_S = 3600
RETENTION_AS_OF = "2024-02-15"
RETENTION_DAYS = 30
