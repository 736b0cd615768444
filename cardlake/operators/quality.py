"""Data-quality checks: each returns the failing rows (none = pass) or a summary.

All checks are one aggregate or one anti-join: no collect, no driver loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Rows where any of ``columns`` is null."""
    cols = [columns] if isinstance(columns, str) else list(columns)
    cond = F.col(cols[0]).isNull()
    for c in cols[1:]:
        cond = cond | F.col(c).isNull()
    return df.filter(cond)


def null_counts(df: DataFrame, checks: Sequence[tuple[str, str]]) -> DataFrame:
    """(model, column_name, failures) for many not-null checks in ONE pass.

    ``checks`` are (model label, column) pairs over ``df`` (models that are
    projections of the same frame share the pass).
    """
    cols = sorted({c for _, c in checks})
    agg = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols])
    rows = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(c).alias("column_name"),
                              F.coalesce(F.col(c), F.lit(0)).cast("long").alias("failures"))
                     for m, c in checks])
    return agg.select(F.inline(rows))


def unique(df: DataFrame, key: str) -> DataFrame:
    """Keys occurring more than once (null keys are not checked): (key, n)."""
    return (df.filter(F.col(key).isNotNull()).groupBy(key)
              .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1))


def foreign_key(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-null ``column`` has no match in the parent."""
    keys = parent.select(F.col(parent_column).alias("_fk")).where(F.col("_fk").isNotNull()).distinct()
    c = child.filter(F.col(column).isNotNull())
    return c.join(keys, c[column] == keys["_fk"], "left_anti")


def failing(df: DataFrame, failure: Column) -> DataFrame:
    """Rows matching a failure predicate, e.g. ``col('amount') < 0``."""
    return df.filter(failure)


def accepted(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that break an acceptance condition (a null result is not a failure,
    as with ``where not (cond)`` in SQL)."""
    return df.filter(~condition)


def amount_non_negative(fact: DataFrame) -> DataFrame:
    return failing(fact, F.col("amount") < 0)


def valid_currency(fact: DataFrame, currencies: DataFrame) -> DataFrame:
    """Fact rows whose currency is unknown (a null currency counts as unknown).

    Same rows as ``left join ... where currency_code is null``; the joined
    column is kept (always null).
    """
    codes = (currencies.select(F.col("currency_code").alias("_code"))
             .where(F.col("_code").isNotNull()).distinct())
    # a null currency never matches: spread those rows over salted keys that
    # cannot match either, so a mass of nulls is no hot key in a shuffled join
    spread = F.when(F.col("currency").isNull(),
                    F.concat(F.lit("\u0000"), (F.abs(F.xxhash64(*fact.columns)) % 4096).cast("string"))
                    ).otherwise(F.col("currency"))
    keyed = fact.withColumn("_ck", spread)
    miss = keyed.join(codes, keyed["_ck"] == codes["_code"], "left_anti").drop("_ck")
    return miss.withColumn("currency_code", F.lit(None).cast("string"))


def profile_parts(df: DataFrame, sketches: bool = True) -> DataFrame:
    """(column_name, row_count, null_count, sketch): what a load adds to a profile, in one pass.

    Parts of loads add up (``profile_of``).  ``sketch`` estimates a column's
    distinct values; it has a fixed size and merges, too.
    """
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(df.columns):
        aggs.append(F.sum(F.col(c).isNull().cast("long")).alias(f"_n_{i}"))
        if sketches:
            aggs.append(F.hll_sketch_agg(F.col(c).cast("string")).alias(f"_s_{i}"))
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col("_rows").cast("long").alias("row_count"),
                              F.coalesce(F.col(f"_n_{i}"), F.lit(0)).cast("long").alias("null_count"),
                              (F.col(f"_s_{i}") if sketches else F.lit(None).cast("binary")).alias("sketch"))
                     for i, c in enumerate(df.columns)])
    return df.agg(*aggs).select(F.inline(rows))


def profile_of(parts: DataFrame, duplicate_keys: Column | None = None, distinct: bool = False) -> DataFrame:
    """The profile that the parts of loads add up to.

    (column_name, row_count, null_count, null_pct, duplicate_keys[, approx_distinct])
    """
    aggs = [F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count")]
    if distinct:
        aggs.append(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("approx_distinct"))
    pct = F.round(F.lit(100).cast("decimal(5,0)") * F.col("null_count") / F.nullif("row_count", F.lit(0)), 2).cast("double")
    dup = F.lit(None) if duplicate_keys is None else duplicate_keys
    return parts.groupBy("column_name").agg(*aggs).select(
        "column_name", "row_count", "null_count", pct.alias("null_pct"), dup.cast("long").alias("duplicate_keys"),
        *(["approx_distinct"] if distinct else []))


def profile(df: DataFrame, key: str | None = None) -> DataFrame:
    """Row count, nulls and null percent per column, and duplicate keys.

    (column_name, row_count, null_count, null_pct, duplicate_keys)
    ``duplicate_keys`` = non-null key rows minus distinct non-null keys, by an
    aggregate of its own that reads the key alone, so the counts of the other
    columns don't ride its shuffle.
    """
    dup = None
    if key:
        per_key = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        dup = per_key.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0))).scalar()
    return profile_of(profile_parts(df, sketches=False), dup)


def freshness(df: DataFrame, as_of, max_lag_s: int = 3600, ts: str = "event_ts") -> DataFrame:
    """One row: newest event time, lag behind ``as_of`` in seconds, stale flag."""
    as_of_c = F.lit(as_of).cast("timestamp")
    newest = df.agg(F.max(ts).alias("max_event_ts"))
    lag = (F.unix_micros(as_of_c) - F.unix_micros(F.col("max_event_ts"))) / F.lit(1_000_000)
    return newest.select("max_event_ts", as_of_c.alias("as_of"), lag.cast("double").alias("lag_seconds"),
                         F.coalesce(lag > F.lit(max_lag_s), F.lit(True)).alias("is_stale"))
