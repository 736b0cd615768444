"""Per-card rules over event time as window expressions (tables).

* velocity: more than ``velocity_n`` events of the card in the last
  ``velocity_s`` seconds, the current one included, lower bound inclusive.
* cross-border: more than one distinct location in the last ``window_s``
  seconds (a null location counts as a value).
* decline rate: the last ``last_n`` events all lie inside ``window_s`` and
  more than ``ratio`` of them are DECLINED; fewer than ``last_n`` -> false.

Order within a card is (event_ts, transaction_id): an event sees the
earlier ones and its own tie group up to itself, never later rows.

Plan: one shuffle on (card, time bucket).  Each row is also copied, as
context, into the next bucket when it lies within the look-back of that
bucket's start, so every frame is complete inside its partition and the
results are exact.  A card with a huge share of all rows is thus split into
one task per bucket instead of one task for the card.  Inside a partition all
rules come from one sort and cost a constant per row: velocity looks back
``velocity_n`` rows, cross-border keeps the running maximum of the times at
which the location changed, the decline rate sums a frame of ``last_n`` rows.
(A sliding time range would be evaluated again over its whole frame for each
row, which is quadratic for a busy card.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlake.functions.columns import micros
from cardlake.operators.rules import ALL_RULES, combine_flags, flag_blacklist, flag_high_amount
from cardlake.schemas import CARD_RULE_COLUMNS

# Fixed defaults of the reference's rules.
VELOCITY_N = 5
VELOCITY_S = 60
WINDOW_S = 600
LAST_N = 10
DECLINE_RATIO = 0.5
BUCKET_S = 3600


def flag_card_rules(df: DataFrame, velocity_n: int = VELOCITY_N, velocity_s: int = VELOCITY_S,
                    window_s: int = WINDOW_S, last_n: int = LAST_N, ratio: float = DECLINE_RATIO,
                    bucket_s: int = BUCKET_S, key: str = "card_hash", ts: str = "event_ts",
                    tie: str = "transaction_id") -> DataFrame:
    """Add rule_velocity, rule_cross_border, rule_decline_rate (batch frames)."""
    lookback_s = max(velocity_s, window_s)
    if bucket_s < lookback_s:
        raise ValueError("bucket_s must be at least the longest look-back")
    bucket_us, velocity_us, window_us = bucket_s * 1_000_000, velocity_s * 1_000_000, window_s * 1_000_000
    us = micros(ts)
    # exact floor division (also for times before 1970)
    own = (us - F.pmod(us, F.lit(bucket_us))).cast("long") / F.lit(bucket_us)
    own = own.cast("long")
    # copy rows near the end of a bucket into the next one as context
    near_next = us >= (own + 1) * F.lit(bucket_us) - F.lit(lookback_s * 1_000_000)
    buckets = F.when(near_next, F.array(own, own + 1)).otherwise(F.array(own))
    cols = df.columns
    x = (df.withColumn("_us", us).withColumn("_own", own)
           .withColumn("_bucket", F.explode_outer(buckets)))
    # context copies only feed the frames: ship them with the payload nulled
    needed = {key, ts, tie, "location", "auth_result"}
    own_row = F.col("_bucket").eqNullSafe(F.col("_own"))
    x = x.select(*[F.col(c) if c in needed else F.when(own_row, F.col(c)).alias(c) for c in cols],
                 "_us", "_own", "_bucket")

    # one window, one sort: every rule is a look back by rows or a running maximum
    w = Window.partitionBy(key, "_bucket").orderBy("_us", tie)
    declined = F.coalesce(F.col("auth_result") == "DECLINED", F.lit(False)).cast("int")
    x = x.select("*",
                 F.lag("_us", velocity_n).over(w).alias("_nth_before"),
                 F.lag("_us", 1).over(w).alias("_before"),
                 F.lag("location", 1).over(w).alias("_loc_before"),
                 F.sum(declined).over(w.rowsBetween(-(last_n - 1), 0)).alias("_declined"),
                 F.lag("_us", last_n - 1).over(w).alias("_oldest"))
    # time of the newest earlier row that a change of location parts from this one
    moved = F.when(~F.col("location").eqNullSafe(F.col("_loc_before")), F.col("_before"))
    x = x.withColumn("_moved", F.max(moved).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))

    def since(c: str, span_us: int) -> Column:
        return F.coalesce(F.col(c) >= F.col("_us") - F.lit(span_us), F.lit(False))

    velocity = since("_nth_before", velocity_us)
    cross = since("_moved", window_us)
    decline = since("_oldest", window_us) & (F.col("_declined") / F.lit(last_n) > F.lit(ratio))

    def known(c: Column) -> Column:
        return F.when(F.col("_us").isNotNull(), c)

    return x.filter(own_row).select(*cols, known(velocity).alias("rule_velocity"),
                                     known(cross).alias("rule_cross_border"),
                                     known(decline).alias("rule_decline_rate"))


def flag_all_rules(payments: DataFrame, blacklist=None, **kw) -> DataFrame:
    """Parsed payments -> five flags + is_fraud + fraud_reason (card-rule layout)."""
    from cardlake.operators.rules import DEFAULT_BLACKLIST
    p = flag_blacklist(flag_high_amount(payments), DEFAULT_BLACKLIST if blacklist is None else blacklist)
    if "date" in p.columns and "event_date" not in p.columns:
        p = p.withColumnRenamed("date", "event_date")
    out = flag_card_rules(p, **kw).select(*CARD_RULE_COLUMNS)
    return combine_flags(out, ALL_RULES)
