"""The time a stream has reached, told from event times that may be wrong.

A payment dated in the future must neither make later payments late nor cut
the tail that rules look back on.  Two bounds see to that:

* An event further ahead of its arrival than ``ahead_s`` is no event of this
  stream (``FUTURE_EVENT``): it is a letter, and enters neither clock nor tail.
* The clock follows what several cards support: it is the ``support``-th newest of
  the cards' own newest times (the oldest of them while there are fewer cards).
  So up to ``support - 1`` cards with wrong dates that are still before their arrival,
  as in a replay of old data, don't move it.

The clock is kept as its ``support`` newest (card, time) rows.  These merge
exactly: a card that is among the newest of all is among the newest of one of
the parts, so a batch costs one map-side combined maximum per card.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlake.functions.columns import micros

CLOCK = "card_hash string, us long"
AHEAD_S = 900
SUPPORT = 3


def too_far_ahead(arrival: Column, ahead_s: int = AHEAD_S, ts: str = "event_ts") -> Column:
    """Whether an event time lies beyond its arrival by more than the bound (false without a time)."""
    return F.coalesce(micros(ts) > micros(arrival) + F.lit(ahead_s * 1_000_000), F.lit(False))


def newest_cards(rows: DataFrame, support: int = SUPPORT, key: str = "card_hash", ts: str = "event_ts") -> DataFrame:
    """The ``support`` cards with the newest times among parsed payments (rows without a time don't count)."""
    return merged_clock(rows.select(F.col(key).alias("card_hash"), micros(ts).alias("us")).where("us is not null"), support)


def merged_clock(cards: DataFrame, support: int = SUPPORT) -> DataFrame:
    """The clock of a union of clocks."""
    return (cards.groupBy("card_hash").agg(F.max("us").alias("us"))
            .orderBy(F.desc("us"), "card_hash").limit(support))


def clock_time(clock: DataFrame) -> int | None:
    """Microseconds that the stream has reached; None before any event."""
    return clock.agg(F.min("us")).first()[0]
