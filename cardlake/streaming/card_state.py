"""Per-card rules on a stream: keyed state with ``applyInPandasWithState``.

Same rules and order as ``operators.card_rules`` (event time, then
transaction id).  Per card the state holds the events of the last
``window_s + late_s`` seconds (epoch micros, id, location, result); each micro-batch
merges its rows with that tail, sorts once, and computes all three rules
with vectorised searches and cumulative sums (no per-row Python loop).
An event sees earlier events only (never a later one that arrived first).

State ends with an event-time timeout: ``idle_s`` after the card's newest
event, once the watermark passes it.  Rows later than the watermark delay
are dropped by Spark before they reach the state.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cardlake.operators.card_rules import (DECLINE_RATIO, LAST_N, VELOCITY_N, VELOCITY_S,
                                           WINDOW_S)
from cardlake.operators.rules import DEFAULT_BLACKLIST, flag_blacklist, flag_high_amount
from cardlake.schemas import CARD_FLAGS, CARD_RULE_COLUMNS, CARD_STATE, PAYMENT

IDLE_S = 900
LATE_S = 900

# The state function runs in Python workers on executors.  Pickle this
# module's functions by value, so executors need numpy/pandas only, not an
# installed copy of this package.
from pyspark import cloudpickle  # noqa: E402

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def card_rule_schema() -> T.StructType:
    fields = list(PAYMENT.fields) + [
        T.StructField("event_ts", T.TimestampType()), T.StructField("event_date", T.DateType()),
        T.StructField("rule_high_amount", T.BooleanType()), T.StructField("rule_blacklist", T.BooleanType()),
    ] + [T.StructField(f, T.BooleanType()) for f in CARD_FLAGS]
    return T.StructType(fields)


def _us(values) -> np.ndarray:
    return np.asarray(values, dtype="datetime64[us]").astype(np.int64)


def card_rules_arrays(ts_us: np.ndarray, locations, declined: np.ndarray, velocity_n: int,
                      velocity_us: int, window_us: int, last_n: int, ratio: float):
    """Rules for rows already sorted by (time, id); returns three bool arrays."""
    n = len(ts_us)
    pos = np.arange(n)
    lo_v = np.searchsorted(ts_us, ts_us - velocity_us, side="left")
    velocity = (pos - lo_v + 1) > velocity_n
    lo_w = np.searchsorted(ts_us, ts_us - window_us, side="left")
    # distinct locations > 1 in [lo_w, pos]  <=>  the run of equal locations
    # that ends at pos starts after lo_w (None equals None: a value of its own)
    locs = np.asarray(locations, dtype=object)
    change = np.ones(n, dtype=bool)
    change[1:] = locs[1:] != locs[:-1]
    run_start = np.maximum.accumulate(np.where(change, pos, 0))
    cross = run_start > lo_w
    cum = np.concatenate([[0], np.cumsum(declined.astype(np.int64))])
    first = pos - (last_n - 1)
    inside = first >= lo_w
    n_declined = cum[pos + 1] - cum[np.clip(first, 0, None)]
    decline = inside & (n_declined / last_n > ratio)
    return velocity, cross, decline


def interval_seconds(delay: str | int) -> int:
    """'15 minutes' / '24 hours' / '90 seconds' / 900 -> seconds."""
    if isinstance(delay, int):
        return delay
    n, unit = delay.split()
    scale = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
    return int(n) * scale


def make_state_fn(velocity_n=VELOCITY_N, velocity_s=VELOCITY_S, window_s=WINDOW_S, last_n=LAST_N,
                  ratio=DECLINE_RATIO, idle_s=IDLE_S, late_s=LATE_S):
    """State function; exact as long as rows arrive no later than ``late_s``
    behind the newest event (the watermark delay, enforced by Spark)."""
    velocity_us, window_us = velocity_s * 1_000_000, window_s * 1_000_000
    # a row that is not late can look back to newest - late - window
    keep_us = (max(window_s, velocity_s) + late_s) * 1_000_000
    # evicting a card earlier than one window after its newest event could
    # hide events from a later row's frame
    idle_s = max(idle_s, window_s, velocity_s)
    out_cols = CARD_RULE_COLUMNS

    def fn(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        chunks = list(batches)
        new = chunks[0] if len(chunks) == 1 else pd.concat(chunks, ignore_index=True)
        if new.empty:
            return
        timeless = new["event_ts"].isna().to_numpy()
        if timeless.any():      # no event time: no rule can be evaluated
            blank = new[timeless].reset_index(drop=True)
            for f in CARD_FLAGS:
                blank[f] = None
            yield blank[out_cols]
            new = new[~timeless].reset_index(drop=True)
            if new.empty:
                return
        old = list(state.get[0]) if state.exists else []
        k = len(old)
        o_ts, o_id, o_loc, o_auth = (zip(*old) if k else ((), (), (), ()))
        # exact epoch micros from Spark (pandas timestamps are session-zone wall time)
        new_us = (new["_ts_us"].to_numpy().astype(np.int64) if "_ts_us" in new.columns
                  else _us(new["event_ts"].to_numpy()))
        ts = np.concatenate([np.fromiter(o_ts, np.int64, k), new_us])
        ids = np.concatenate([np.array(o_id, dtype=object), new["transaction_id"].to_numpy(dtype=object)])
        locs = np.concatenate([np.array(o_loc, dtype=object), new["location"].to_numpy(dtype=object)])
        auth = np.concatenate([np.array(o_auth, dtype=object), new["auth_result"].to_numpy(dtype=object)])
        row = np.concatenate([np.full(k, -1), np.arange(len(new))])
        order = np.lexsort((ids.astype(str), ts))
        ts, ids, locs, auth, row = ts[order], ids[order], locs[order], auth[order], row[order]
        v, c, d = card_rules_arrays(ts, locs, auth == "DECLINED", velocity_n, velocity_us,
                                    window_us, last_n, ratio)
        is_new = row >= 0
        out = new.iloc[row[is_new]].reset_index(drop=True)
        out["rule_velocity"], out["rule_cross_border"], out["rule_decline_rate"] = v[is_new], c[is_new], d[is_new]
        # keep the tail that later (possibly late) rows can still see
        newest = int(ts[-1])
        keep = ts >= newest - keep_us
        state.update((list(zip(ts[keep].tolist(), ids[keep].tolist(), locs[keep].tolist(),
                               auth[keep].tolist())),))
        wm = state.getCurrentWatermarkMs()
        state.setTimeoutTimestamp(max(newest // 1000 + idle_s * 1000, wm + 1))
        yield out[out_cols]

    return fn


def flag_card_rules_stream(payments: DataFrame, blacklist=DEFAULT_BLACKLIST, delay: str | int = "15 minutes",
                           **params) -> DataFrame:
    """Streaming parsed payments -> card-rule layout (17 columns).

    ``payments`` has the raw columns, event_ts and date.  Stateless rules
    run before the shuffle on card_hash; the state function adds the rest.
    """
    p = flag_blacklist(flag_high_amount(payments), blacklist)
    if "event_date" not in p.columns:
        p = p.withColumnRenamed("date", "event_date")
    late_s = interval_seconds(delay)
    p = (p.select(*[c for c in CARD_RULE_COLUMNS if c not in CARD_FLAGS],
                  F.unix_micros("event_ts").alias("_ts_us"))
          .withWatermark("event_ts", f"{late_s} seconds"))
    return p.groupBy("card_hash").applyInPandasWithState(
        make_state_fn(late_s=late_s, **params), card_rule_schema(), CARD_STATE, "append",
        GroupStateTimeout.EventTimeTimeout)
