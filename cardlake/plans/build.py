"""Build the warehouse models in dependency order (staging -> facts/dims -> marts).

``build_models`` returns the frames; with ``out_path`` each model is written
(facts and marts partitioned by ``date`` so day reports prune) and the
returned frames read the written tables back, so later models and callers
reuse the stored result instead of recomputing the chain (lineage cut).  The
tables are a new snapshot (``plans.snapshots``), published when all are
written, so readers have the models of the last build until then.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame

from cardlake.operators import models
from cardlake.plans.snapshots import Draft

# name -> (models it reads, builder, written partitioned by date)
MODEL_GRAPH = {
    "stg_transactions": (("transactions",), models.stg_transactions, False),
    "fact_transactions": (("stg_transactions",), models.fact_transactions, True),
    "fact_fraud_signals": (("stg_transactions",), models.fact_fraud_signals, True),
    "dim_merchants": (("stg_transactions",), models.dim_merchants, False),
    "dim_currency": (("stg_transactions",), models.dim_currency, False),
    "dim_auth_results": (("stg_transactions",), models.dim_auth_results, False),
    "mart_settlement_daily": (("fact_transactions", "dim_merchants"), models.mart_settlement_daily, True),
    "mart_fraud_settlement_daily": (("fact_transactions", "dim_merchants"),
                                    models.mart_fraud_settlement_daily, True),
    "mart_fraud_rate": (("fact_fraud_signals", "dim_merchants"), models.mart_fraud_rate, True),
    "mart_currency_volume": (("fact_transactions", "dim_currency"), models.mart_currency_volume, True),
    "mart_channel_performance": (("fact_transactions", "dim_merchants"),
                                 models.mart_channel_performance, True),
    "mart_fraud_alerts": (("fact_transactions", "dim_merchants"), models.mart_fraud_alerts, True),
}


def build_order() -> list[str]:
    """Topological order of MODEL_GRAPH (inputs before the models reading them)."""
    done: list[str] = []
    seen = {"transactions"}

    def visit(name: str) -> None:
        if name in seen:
            return
        for dep in MODEL_GRAPH[name][0]:
            visit(dep)
        seen.add(name)
        done.append(name)

    for n in MODEL_GRAPH:
        visit(n)
    return done


def build_levels() -> list[list[str]]:
    """Models grouped by dependency depth: a level reads only earlier levels."""
    depth: dict[str, int] = {"transactions": 0}
    for name in build_order():
        depth[name] = 1 + max(depth[d] for d in MODEL_GRAPH[name][0])
    levels: dict[int, list[str]] = {}
    for name in build_order():
        levels.setdefault(depth[name], []).append(name)
    return [levels[k] for k in sorted(levels)]


# the marts in their exact form (one row per merchant instead of one per dimension row)
EXACT = {
    **{n: partial(fn, one_row_per_merchant=True) for n, fn in (
        ("mart_settlement_daily", models.mart_settlement_daily),
        ("mart_fraud_settlement_daily", models.mart_fraud_settlement_daily),
        ("mart_fraud_rate", models.mart_fraud_rate), ("mart_fraud_alerts", models.mart_fraud_alerts))},
    "mart_channel_performance": models.mart_channel_performance_exact,
}


def build_models(transactions: DataFrame, out_path: str | None = None, staging_as_view: bool = True,
                 threads: int = 4, one_row_per_merchant: bool = False) -> dict[str, DataFrame]:
    """All models from the warehouse ``transactions`` frame.

    ``one_row_per_merchant`` builds the marts in their exact form.
    Staging stays a view (a projection, never written).  Models of
    one dependency level are independent; their writes are submitted from
    ``threads`` driver threads, so Spark runs those jobs side by side.
    """
    from concurrent.futures import ThreadPoolExecutor

    draft = Draft(transactions.sparkSession, out_path, empty=True) if out_path else None
    built: dict[str, DataFrame] = {"transactions": transactions}

    def make(name: str) -> DataFrame:
        deps, fn, by_date = MODEL_GRAPH[name]
        if one_row_per_merchant and name in EXACT:
            fn = EXACT[name]
            if name == "mart_channel_performance":
                deps = ("stg_transactions", "dim_merchants")
        df = fn(*[built[d] for d in deps])
        if draft is None or (staging_as_view and name == "stg_transactions"):
            return df
        if by_date:
            draft.write(df, name)
        else:
            draft.write_whole(df, name)
        return draft.read(name)

    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        for level in build_levels():
            for name, df in zip(level, pool.map(make, level)):
                built[name] = df
    built.pop("transactions")
    if draft is not None:
        draft.publish()
    return built
