"""Lake layers: bronze -> silver (dedup, amount check) -> warehouse projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.schemas import MONEY, WAREHOUSE_COLUMNS

DEDUP_KEYS = ("transaction_id", "event_ts")
DEDUP_DELAY = "24 hours"


def dedup_first(df: DataFrame, keys: Sequence[str] = DEDUP_KEYS,
                order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per key (null keys compare equal): the first seen.

    First is by ``order_by`` (e.g. an arrival sequence).  Without it the order is
    that of arrival as files tell it: the time at which the row's file was
    written, then its path (``with_arrival``); for a frame that doesn't read files,
    the order of its rows.  Spark packs files into tasks by size, so the order
    of reading says nothing about arrival.  Implemented as an aggregate of
    ``min(struct(...))`` so Spark combines map-side before the shuffle:
    a key repeated millions of times collapses in each task instead of
    landing whole on one reducer (a window's row_number would ship it all).
    """
    keys = list(keys)
    columns = df.columns
    if order_by is None:
        df, order_by = with_arrival(df), list(ARRIVAL)
    order = list(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest]).alias("_row")
    picked = df.groupBy(*keys).agg(F.min(packed).alias("_row"))
    return picked.select(*[F.col(k) for k in keys],
                         *[F.col(f"_row.{c}").alias(c) for c in order + rest]).select(*columns)


ARRIVAL = ("_written", "_file", "_row")


def with_arrival(df: DataFrame) -> DataFrame:
    """``df`` with the columns that order rows by arrival (see ``dedup_first``)."""
    try:
        read = df.select("*", F.col("_metadata.file_modification_time").alias("_written"),
                         F.col("_metadata.file_path").alias("_file"))
    except AnalysisException:   # not a scan of files: no file's time to go by
        read = df.select("*", F.lit(None).cast("timestamp").alias("_written"), F.lit(None).cast("string").alias("_file"))
    return read.withColumn("_row", F.monotonically_increasing_id())


def to_silver(df: DataFrame, delay: str = DEDUP_DELAY, processed_at=None,
              order_by: Sequence[str] | None = None, keys: Sequence[str] = DEDUP_KEYS,
              within_watermark: bool = False) -> DataFrame:
    """Bronze -> silver: dedup on (transaction_id, event_ts), then amount >= 0.

    The amount filter stays *after* the dedup (as in the reference): a first
    copy with a negative amount removes its later good copy too.  Streaming
    input uses a watermark-bounded ``dropDuplicates`` (rows later than
    ``delay`` are dropped and id state expires); batch input the aggregate
    above.  Both keep the first seen copy.
    """
    if df.isStreaming:
        marked = df.withWatermark("event_ts", delay)
        # within_watermark: keys need not contain the event time (e.g. the id
        # alone); a key's state lives ``delay`` past its first event time
        deduped = (marked.dropDuplicatesWithinWatermark(list(keys)) if within_watermark
                   else marked.dropDuplicates(list(keys)))
    else:
        deduped = dedup_first(df, keys, order_by)
    stamp = F.current_timestamp() if processed_at is None else F.lit(processed_at).cast("timestamp")
    return (deduped.withColumn("amount", F.col("amount").cast("double"))
                   .withColumn("processed_at", stamp)
                   .filter(F.col("amount") >= 0))


def to_warehouse(df: DataFrame, require_id: bool = True) -> DataFrame:
    """Silver -> warehouse ``transactions``: 17 columns, money as decimal(18,2).

    ``try_cast``: an amount that does not fit becomes null (and fails the
    not-null check) instead of failing the load.
    """
    cols = [F.col("amount").try_cast(MONEY).alias("amount") if c == "amount" else F.col(c)
            for c in WAREHOUSE_COLUMNS]
    out = df.select(*cols)
    return out.filter(F.col("transaction_id").isNotNull()) if require_id else out


def with_processed_at(df: DataFrame, processed_at=None) -> DataFrame:
    stamp = F.current_timestamp() if processed_at is None else F.lit(processed_at).cast("timestamp")
    return df.withColumn("processed_at", stamp)
