"""Per-card rules on a stream, one batch at a time with the table operators.

Each micro-batch is joined to the tail of the stream (the events a new row can
still look back to) and decided by ``operators.card_rules``: one shuffle on
(card, time bucket), all rules on the JVM, a busy card split into buckets.
Nothing is kept per card and no card's rows have to fit one task.

* On time are rows that are at most ``delay`` behind the clock of the batches
  before (``streaming.clock``: a time that several cards have reached).  Later
  ones are not decided; they go to the dead letter as ``LATE_EVENT``.  Rows
  dated further ahead of their arrival than ``ahead_s`` go there as
  ``FUTURE_EVENT``, and neither the clock nor the tail hears of them.
* A payload is parsed once: the parsed batch is kept while its sinks are written.
* The tail (card, time, id, location, result of the last ``delay`` plus the
  longest look-back) and the clock are written after each batch into one of two
  folders in turn, so a batch that is run again still finds those it began with.
* Decided rows and letters are written under the id of the load (stream
  generation and batch), with dynamic overwrite: a repeated batch replaces
  itself, and a new checkpoint never touches rows of an older one.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.functions.columns import micros
from cardlake.operators.card_rules import VELOCITY_S, WINDOW_S, flag_card_rules
from cardlake.operators.parse import FUTURE_EVENT, LATE_EVENT, split_payloads, tag_payloads
from cardlake.operators.routing import dead_letter, undecided_as_invalid
from cardlake.operators.rules import (ALL_RULES, DEFAULT_BLACKLIST, combine_flags, flag_blacklist,
                                      flag_high_amount, route)
from cardlake.schemas import CARD_RULE_COLUMNS
from cardlake.streaming.clock import (AHEAD_S, CLOCK, SUPPORT, clock_time, merged_clock, newest_cards,
                                      too_far_ahead)

TAIL = "card_hash string, event_ts timestamp, transaction_id string, location string, auth_result string"
TAIL_COLUMNS = [c.split()[0] for c in TAIL.split(", ")]


def load_id(spark: SparkSession, checkpoint: str, batch_id: int) -> str:
    """Name of a micro-batch that no other checkpoint generation shares."""
    meta = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
    return f"{json.loads(meta)['id'][:8]}-{int(batch_id):09d}"


def replace_load(df: DataFrame, path: str, load: str, partitions: tuple[str, ...] = ()) -> None:
    """Write one load into its own partitions, replacing an earlier try of the same load."""
    (df.withColumn("load_id", F.lit(load)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*partitions, "load_id").parquet(path))


def card_rules_writer(decided_path: str, checkpoint: str, delay_s: int, dlq_path: str | None = None,
                      kafka: tuple[str, str] | None = None, blacklist=DEFAULT_BLACKLIST, payloads: bool = True,
                      as_of=None, ahead_s: int = AHEAD_S, support: int = SUPPORT,
                      **rule_params) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function; see the module text.

    ``payloads``: the batch has a raw JSON ``value`` column; otherwise it has
    the columns of parsed payments.  ``as_of`` stands for the time of arrival
    (default: the time at which the batch is run).
    """
    look_back = max(rule_params.get("velocity_s", VELOCITY_S), rule_params.get("window_s", WINDOW_S))
    keep_us = (look_back + delay_s) * 1_000_000
    root = checkpoint.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        load = load_id(spark, root, batch_id)
        batch = (tag_payloads(batch) if payloads else batch).persist(StorageLevel.MEMORY_AND_DISK)
        now = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
        try:
            valid, invalid = split_payloads(batch, as_of) if payloads else (batch, None)
            last, this = (batch_id - 1) % 2, batch_id % 2
            tail, clock = ((spark.read.schema(TAIL).parquet(f"{root}/tail/{last}"),
                            spark.read.schema(CLOCK).parquet(f"{root}/clock/{last}")) if batch_id
                           else (spark.createDataFrame([], TAIL), spark.createDataFrame([], CLOCK)))
            newest = clock_time(clock)
            future = too_far_ahead(now, ahead_s)
            on_time = F.lit(True) if newest is None else F.coalesce(
                micros("event_ts") >= F.lit(newest - delay_s * 1_000_000), F.lit(True))
            fresh = valid.filter(on_time & ~future)
            p = flag_blacklist(flag_high_amount(fresh), blacklist)
            if "event_date" not in p.columns:
                p = p.withColumnRenamed("date", "event_date")
            rows = p.withColumn("_new", F.lit(True)).unionByName(
                tail.withColumn("_new", F.lit(False)), allowMissingColumns=True)
            decided = combine_flags(flag_card_rules(rows, **rule_params).filter("_new")
                                    .select(*CARD_RULE_COLUMNS), ALL_RULES)
            replace_load(decided, decided_path, load, ("event_date",))
            if dlq_path or kafka:
                reason = F.when(future, F.lit(FUTURE_EVENT)).otherwise(F.lit(LATE_EVENT))
                late = (valid.filter(~on_time | future).withColumn("error_reason", reason)
                        .withColumn("dlq_ts", now))
                # read back what was written: decided once, whatever the sinks
                back = (spark.read.parquet(decided_path).filter(F.col("load_id") == load)
                        .select(*decided.columns) if _any(spark, decided_path, load) else decided.limit(0))
                _, flagged, undecided = route(back)
                other = undecided_as_invalid(undecided, as_of).unionByName(late, allowMissingColumns=True)
                if invalid is not None:
                    other = other.unionByName(invalid, allowMissingColumns=True)
                letters = dead_letter(flagged, other, as_of=as_of)
                if kafka:
                    (letters.write.format("kafka").option("kafka.bootstrap.servers", kafka[0])
                     .option("topic", kafka[1]).save())
                else:
                    replace_load(letters, dlq_path, load)
            merged_clock(clock.unionByName(newest_cards(fresh, support)), support).coalesce(1) \
                .write.mode("overwrite").parquet(f"{root}/clock/{this}")
            reached = clock_time(spark.read.schema(CLOCK).parquet(f"{root}/clock/{this}"))
            (tail.unionByName(fresh.select(*TAIL_COLUMNS))
             .filter(micros("event_ts") >= F.lit((reached or 0) - keep_us))
             .write.mode("overwrite").parquet(f"{root}/tail/{this}"))
        finally:
            batch.unpersist()

    return write


def _any(spark: SparkSession, path: str, load: str) -> bool:
    """Whether the load wrote any file (an empty batch writes none)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/*/load_id={load}")
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0
