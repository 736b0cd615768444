"""Incremental model refresh: re-read only the days that received rows.

The warehouse only grows, so a refresh knows the days that changed.  Facts
of those days are written anew, the dimensions grow by the new rows' values,
and the marts are rebuilt from small per-day base aggregates:

* base_settlement (date, merchant, currency), base_merchant_day
  (date, merchant), base_currency (date, currency): unscaled sums and
  distinct counts, recomputed for the changed days only;
* the as-written marts scale these by the current dimension row counts, so
  a new dimension row (which changes a merchant's factor on *every* day)
  costs a join of small tables, not a re-read of the facts;
* the alerts (row copies) and the channel mart's distinct counts depend on
  the dimension beyond a factor: they are recomputed for the changed days
  plus the days of merchants whose factor or channel set changed, which the
  (date, merchant) base tells without a look at the facts.

All of it goes to a draft (``plans.snapshots``): folders of the next version,
which readers see once its list is published, the last write.  So readers
always have the models of one refresh, whole; a refresh that stops anywhere
leaves them as they were and is repeated by the next.  The list also tells the
loads that the version covers.

Dates may be null; such rows form a day of their own.  The result equals
``build_models`` over the whole warehouse (tested).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.operators import models
from cardlake.plans.snapshots import Draft, Snapshot

DIMENSIONS = {"dim_merchants": models.dim_merchants, "dim_currency": models.dim_currency,
              "dim_auth_results": models.dim_auth_results}
MARTS = ("mart_settlement_daily", "mart_fraud_settlement_daily", "mart_fraud_rate", "mart_currency_volume",
         "mart_channel_performance", "mart_fraud_alerts")


def published(spark: SparkSession, out_path: str) -> tuple[int, list[tuple[str, int]], set[str]]:
    """(version, [(stream generation, last batch)], models) of the published refresh; version 0: none."""
    snap = Snapshot(spark, out_path)
    loads = [(name, number) for kind, name, _, number, _ in snap.notes if kind == "load"]
    return snap.version, loads, {name for kind, name, *_ in snap.notes if kind == "model"}


def _days(df: DataFrame) -> list[str | None]:
    """Distinct dates of a frame, a null one included (bounded by the calendar, safe to collect)."""
    return [None if r[0] is None else str(r[0]) for r in df.select("date").distinct().collect()]


def _in_days(df: DataFrame, days: Sequence[str | None]) -> DataFrame:
    known = [F.lit(d).cast("date") for d in days if d is not None]
    chosen = F.col("date").isin(known) if known else F.lit(False)
    return df.filter(chosen | F.col("date").isNull() if None in days else chosen)


def _together(*jobs: Callable[[], object], threads: int = 4) -> list:
    """Run independent Spark actions from a few driver threads (Spark runs
    their jobs side by side); returns their results in order."""
    with ThreadPoolExecutor(max_workers=threads) as pool:
        return [f.result() for f in [pool.submit(j) for j in jobs]]


def _changed(old_k: DataFrame, new_k: DataFrame, keys: list[str]) -> DataFrame:
    """Merchants with a different factor (or channel set) than before.

    Null-safe on the keys (a null channel is a value of its own)."""
    o, n = old_k.alias("o"), new_k.alias("n")
    cond = None
    for c in keys:
        e = F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}"))
        cond = e if cond is None else cond & e
    j = o.join(n, cond, "full_outer")
    diff = ~F.col("o._k").eqNullSafe(F.col("n._k"))
    merchant = F.coalesce(F.col("o.merchant_id"), F.col("n.merchant_id")).alias("merchant_id")
    return j.filter(diff).select(merchant).distinct()


def refresh_models(transactions: DataFrame, out_path: str, days: Sequence[str | None] | None = None,
                   fee_rate: str = models.FEE_RATE, marts: Sequence[str] = MARTS,
                   one_row_per_merchant: bool = False,
                   loads: Sequence[tuple[str, int]] = ()) -> dict[str, DataFrame]:
    """Bring the models under ``out_path`` up to date with ``transactions``.

    ``days``: dates (None: rows without one) that received rows since the
    last published refresh.  All days are built on the first run, where
    ``days`` is None, and where the published refresh lacks one of ``marts``
    or had them in the other form.  ``one_row_per_merchant`` builds the exact
    marts.  ``loads``: the last batch of each stream generation that
    ``transactions`` covers, published with the version.
    """
    spark = transactions.sparkSession
    version, _, before = published(spark, out_path)
    wanted = set(marts) | {f"exact={one_row_per_merchant}"}
    first = version == 0 or not wanted <= before
    stg = models.stg_transactions(transactions)
    result = [*DIMENSIONS, "fact_transactions", "fact_fraud_signals", *marts]
    if not first and days is not None and not days:     # nothing came in
        return {"stg_transactions": stg, **{n: Snapshot(spark, out_path).read(n) for n in result}}
    draft = Draft(spark, out_path, empty=first)
    read, old = draft.read, draft.before

    def needs(*names: str) -> bool:
        return bool(set(names) & set(marts))

    if first or days is None:
        days = _days(stg)
    stg_days = _in_days(stg, days)

    def grow(name: str) -> None:
        fresh = DIMENSIONS[name](stg_days)
        draft.write_whole(fresh if first else old.read(name).unionByName(fresh).distinct(), name)

    # facts of the changed days, and a new version of the dimensions
    _together(lambda: draft.write(models.fact_transactions(stg_days), "fact_transactions", days),
              lambda: draft.write(models.fact_fraud_signals(stg_days), "fact_fraud_signals", days),
              *[(lambda n=n: grow(n)) for n in DIMENSIONS])
    dims = {n: read(n) for n in DIMENSIONS}
    dim_m = dims["dim_merchants"]
    k = models.merchant_multiplicity(dim_m, one_row_per_merchant)
    pairs = models.channel_pairs(dim_m)

    # per-day bases of the changed days
    fact = read("fact_transactions")
    fact_days = _in_days(fact, days)
    bases = [lambda: draft.write(models.merchant_day_base(fact_days), "base_merchant_day", days)]
    if needs("mart_settlement_daily"):
        bases.append(lambda: draft.write(models.settlement_base(fact_days), "base_settlement", days))
    if needs("mart_currency_volume"):
        bases.append(lambda: draft.write(models.currency_base(fact_days), "base_currency", days))
    _together(*bases)
    day_base = read("base_merchant_day")

    # copies and channel ids: also the days of merchants whose factor or channels changed
    if not first and not one_row_per_merchant:
        old_dim = old.read("dim_merchants")
        presence = lambda p: p.select("merchant_id", "channel", F.lit(1).alias("_k"))
        k_changed = _changed(models.merchant_multiplicity(old_dim), k, ["merchant_id"])
        p_changed = _changed(presence(models.channel_pairs(old_dim)), presence(pairs), ["merchant_id", "channel"])
        k_days, p_days = _together(
            lambda: _days(day_base.filter("_fc > 0").join(k_changed, "merchant_id", "left_semi")),
            lambda: _days(day_base.join(p_changed, "merchant_id", "left_semi")))
    else:
        k_days = p_days = []
    rows = []
    if needs("mart_fraud_alerts"):
        alert_days = list({*days, *k_days})
        rows.append(lambda: draft.write(models.mart_fraud_alerts(_in_days(fact, alert_days), dim_m,
                                                                 one_row_per_merchant), "mart_fraud_alerts", alert_days))
    if needs("mart_channel_performance"):
        if one_row_per_merchant:
            rows.append(lambda: draft.write(models.mart_channel_performance_exact(stg_days, dim_m),
                                            "mart_channel_performance", days))
        else:
            id_days = list({*days, *p_days})
            rows.append(lambda: draft.write(models.channel_ids_base(_in_days(fact, id_days), pairs),
                                            "base_channel_ids", id_days))
    _together(*rows)

    # marts from the (small) bases, rebuilt whole
    built = {
        "mart_settlement_daily": lambda: models.settlement_from_base(read("base_settlement"), k, fee_rate),
        "mart_fraud_settlement_daily": lambda: models.fraud_settlement_from_base(day_base, k),
        "mart_fraud_rate": lambda: models.fraud_rate_from_base(day_base, k),
        "mart_currency_volume": lambda: models.currency_from_base(
            read("base_currency"), models.currency_multiplicity(dims["dim_currency"])),
    }
    if not one_row_per_merchant:
        built["mart_channel_performance"] = lambda: models.channel_from_bases(day_base, read("base_channel_ids"),
                                                                              pairs)
    _together(*[(lambda n=n, f=f: draft.write(f(), n)) for n, f in built.items() if n in marts])

    draft.publish([("load", g, None, int(b), None) for g, b in loads]
                  + [("model", name, None, None, None) for name in sorted(wanted)])
    return {"stg_transactions": stg, **{n: read(n) for n in result}}
