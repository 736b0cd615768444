"""Column expressions shared by the operators (all JVM-side, codegen'd)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


# date and time of day, no zone designator at the end
_NO_ZONE = r"^\s*\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?\s*$"


def event_time(ts_text: Column | str) -> Column:
    """ISO-8601 text -> timestamp; unparseable text -> null.

    Text with an offset is exact; text without one is read as UTC (what the
    reference's UTC sessions do), whatever this session's zone.
    ``try_to_timestamp`` keeps ANSI mode from failing the whole job on one
    bad row (the reference's Spark 3.5 default gave null as well).
    """
    c = F.col(ts_text) if isinstance(ts_text, str) else ts_text
    text = F.when(c.rlike(_NO_ZONE), F.concat(F.trim(c), F.lit("Z"))).otherwise(c)
    return F.try_to_timestamp(text)


DAY_US = 86_400_000_000


def utc_day(ts: Column | str) -> Column:
    """The UTC calendar day of an instant, whatever the session time zone.

    (``to_date`` would use the session zone; the day decides partitions and
    mart rows, so it is computed from epoch microseconds instead.)
    """
    us = micros(ts)
    return F.date_from_unix_date(((us - F.pmod(us, F.lit(DAY_US))) / F.lit(DAY_US)).cast("int"))


def micros(ts: Column | str) -> Column:
    """Timestamp -> microseconds since epoch (a numeric range-frame key)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(c.cast("timestamp"))


def any_true(flags: Sequence[Column | str]) -> Column:
    """Three-valued OR of flag columns (null OR false = null, null OR true = true)."""
    cols = [F.col(f) if isinstance(f, str) else f for f in flags]
    out = cols[0]
    for c in cols[1:]:
        out = out | c
    return out


def reason_list(rules: Sequence[tuple[str, str]]) -> Column:
    """Comma list of the reasons whose flag is true, in the given order.

    ``rules`` is ``[(flag_column, REASON), ...]``; a null or false flag adds
    nothing, no true flag gives the empty string.
    """
    return F.concat_ws(",", *[F.when(F.col(flag), F.lit(reason)) for flag, reason in rules])
