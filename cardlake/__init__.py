"""cardlake: card-payment analytics on Spark DataFrames and Structured Streaming.

Every transform is a ``DataFrame -> DataFrame`` function so that Catalyst sees
one declarative plan; no session, path or credential is created inside the
library (callers pass them in).
"""

__version__ = "0.1.0"

from cardlake.operators.card_rules import flag_all_rules, flag_card_rules  # noqa: E402
from cardlake.operators.layers import dedup_first, to_silver, to_warehouse  # noqa: E402
from cardlake.operators.models import (dim_auth_results, dim_currency, dim_merchants,  # noqa: E402
                                       fact_fraud_signals, fact_transactions,
                                       mart_channel_performance, mart_currency_volume,
                                       mart_fraud_alerts, mart_fraud_rate,
                                       mart_fraud_settlement_daily, mart_settlement_daily,
                                       stg_transactions)
from cardlake.operators.parse import parse_payments  # noqa: E402
from cardlake.operators.routing import dead_letter, dead_letters  # noqa: E402
from cardlake.operators.rules import (combine_flags, flag_blacklist, flag_high_amount,  # noqa: E402
                                      flag_stateless, route)
from cardlake.plans.build import build_models  # noqa: E402
from cardlake.plans.refresh import LakePaths, daily_reports, hourly_refresh  # noqa: E402
from cardlake.plans.reports import export_report, retention_candidates  # noqa: E402
from cardlake.streaming.card_state import flag_card_rules_stream  # noqa: E402
from cardlake.streaming.jobs import (run_silver, run_warehouse, start_card_rules_ingest,  # noqa: E402
                                     start_ingest, start_routed_ingest, warehouse_writer)
