"""Streaming jobs: ingest (raw -> bronze + dead letter), silver, warehouse load."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cardlake.operators.layers import to_silver, to_warehouse
from cardlake.operators.parse import parse_payments
from cardlake.operators.routing import dead_letters, decide_payloads, letters_of
from cardlake.operators.rules import DEFAULT_BLACKLIST, flag_stateless, route
from cardlake.schemas import BRONZE, BRONZE_COLUMNS, SILVER
from cardlake.sources.jdbc import append_table, execute
from cardlake.streaming.card_batches import card_rules_writer, load_id, replace_load
from cardlake.streaming.card_state import interval_seconds
from cardlake.streaming.fanout import fanout_writer
from cardlake.streaming.sinks import kafka_sink, parquet_sink, trigger_kwargs

DATABASE_MAX_FILES = 10
JDBC_BATCH_ROWS = 10000
JDBC_WRITERS = 2


def start_ingest(lines: DataFrame, bronze_path: str, checkpoint_root: str,
                 dlq_path: str | None = None, kafka: tuple[str, str] | None = None,
                 trigger: str | None = "10 seconds", blacklist=DEFAULT_BLACKLIST,
                 delay: str = "15 minutes", as_of=None) -> list[StreamingQuery]:
    """Raw payloads -> bronze (all parsed rows, by ``date``) + dead letter.

    Dead letter = flagged rows, undecided rows (null decision) and payloads
    that do not parse, as (key, value JSON) to a topic (``kafka=(servers,
    topic)``) or to parquet at ``dlq_path``.  Two queries from one plan, as
    in the reference; each reads the source (cheap for a topic).  File sinks
    are exactly-once through their commit log; a topic sink is at-least-once
    (a replayed batch may repeat letters: consumers key on transaction id and
    reason).
    """
    valid, _ = parse_payments(lines, as_of=as_of)
    bronze = flag_stateless(valid.withWatermark("event_ts", delay), blacklist)
    queries = [parquet_sink(bronze, bronze_path, f"{checkpoint_root}/bronze", ["date"], trigger)]
    # one pass over each micro-batch (not a union of three branches of it)
    if kafka or dlq_path:
        letters = dead_letters(lines, blacklist, as_of=as_of)
        queries.append(_letters_sink(letters, dlq_path, kafka, checkpoint_root, trigger))
    return queries


def start_routed_ingest(lines: DataFrame, clean_path: str, flagged_path: str, checkpoint_root: str,
                        dlq_path: str | None = None, kafka: tuple[str, str] | None = None,
                        trigger: str | None = "10 seconds", blacklist=DEFAULT_BLACKLIST,
                        delay: str = "15 minutes", as_of=None, one_pass: bool = False) -> list[StreamingQuery]:
    """Variant with three sinks: dead letter, clean and flagged parquet (no day partitions).

    Every payload ends in clean, flagged or the dead letter: flagged rows,
    rows whose decision is null (``MISSING_AMOUNT``) and payloads that don't
    parse are letters, as in ``start_ingest``.  A dead-letter target is
    required, since undecided rows have no other sink.

    ``one_pass``: one query that reads and parses each micro-batch once and
    gives it to all three sinks (``streaming.fanout``); their folders are then
    laid out by ``load_id``.  Otherwise three queries, each of which reads the
    source and writes through its own file-sink log.  A set of sink folders and
    checkpoints belongs to one of the two forms.
    """
    if not (kafka or dlq_path):
        raise ValueError("the routed ingest needs a dead-letter sink (dlq_path or kafka)")
    if one_pass:
        checkpoint = f"{checkpoint_root}/routed"
        good = F.col("_error").isNull()

        def to_topic(letters: DataFrame, load: str) -> None:
            (letters.write.format("kafka").option("kafka.bootstrap.servers", kafka[0])
             .option("topic", kafka[1]).save())

        def to_files(path: str):
            return lambda rows, load: replace_load(rows, path, load)
        sinks = {"letters": (lambda rows: letters_of(rows, as_of), to_topic if kafka else to_files(dlq_path)),
                 "clean": (lambda rows: rows.filter(good & ~F.col("is_fraud")).select(*BRONZE_COLUMNS),
                           to_files(clean_path)),
                 "flagged": (lambda rows: rows.filter(good & F.col("is_fraud")).select(*BRONZE_COLUMNS),
                             to_files(flagged_path))}
        writer = fanout_writer(lambda batch: decide_payloads(batch, blacklist), sinks, checkpoint)
        return [(lines.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint)
                 .trigger(**trigger_kwargs(trigger)).start())]
    valid, _ = parse_payments(lines, as_of=as_of)
    bronze = flag_stateless(valid.withWatermark("event_ts", delay), blacklist)
    clean, flagged, _ = route(bronze)
    return [_letters_sink(dead_letters(lines, blacklist, as_of=as_of), dlq_path, kafka, checkpoint_root, trigger),
            parquet_sink(clean, clean_path, f"{checkpoint_root}/clean", (), trigger),
            parquet_sink(flagged, flagged_path, f"{checkpoint_root}/flagged", (), trigger)]


def _letters_sink(letters: DataFrame, dlq_path: str | None, kafka: tuple[str, str] | None,
                  checkpoint_root: str, trigger: str | None) -> StreamingQuery:
    if kafka:
        return kafka_sink(letters, kafka[0], kafka[1], f"{checkpoint_root}/dlq", trigger)
    return parquet_sink(letters, dlq_path, f"{checkpoint_root}/dlq", (), trigger)


def start_card_rules_ingest(lines: DataFrame, decided_path: str, checkpoint_root: str,
                            dlq_path: str | None = None, kafka: tuple[str, str] | None = None,
                            trigger: str | None = "1 minute", blacklist=DEFAULT_BLACKLIST,
                            delay: str = "15 minutes", as_of=None, payloads: bool = True,
                            **rule_params) -> list[StreamingQuery]:
    """All five rules on a stream (``streaming.card_batches``).

    Decided rows go to ``decided_path`` (by ``event_date``, then load);
    readers split clean / flagged with ``route``.  The dead letter has flagged
    rows, rows without a decision (``MISSING_AMOUNT``), rows later than
    ``delay`` (``LATE_EVENT``, not decided), rows dated ahead of their arrival
    (``FUTURE_EVENT``, not decided) and payloads that don't parse, so every
    payload is in one of the two.  ``payloads=False``: the stream has parsed
    payments instead of a JSON ``value``.  ``ahead_s`` and ``support``: see
    ``streaming.clock``.
    """
    checkpoint = f"{checkpoint_root}/decided"
    writer = card_rules_writer(decided_path, checkpoint, interval_seconds(delay), dlq_path, kafka, blacklist,
                               payloads, as_of, **rule_params)
    return [(lines.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint)
             .trigger(**trigger_kwargs(trigger)).start())]


def await_all(queries: Sequence[StreamingQuery]) -> None:
    for q in queries:
        q.awaitTermination()


def await_any(spark: SparkSession, timeout_s: float | None = None) -> None:
    """Block until any active query of the session stops (or fails)."""
    if timeout_s is None:
        spark.streams.awaitAnyTermination()
    else:
        spark.streams.awaitAnyTermination(timeout_s)


def late_rows(df: DataFrame, newest_seen, delay_s: int, ts: str = "event_ts") -> DataFrame:
    """Side output: rows older than ``newest_seen - delay`` (the ones a
    watermark with that delay drops), for audit or replay."""
    limit = F.lit(newest_seen).cast("timestamp") - F.expr(f"INTERVAL {int(delay_s)} SECONDS")
    return df.filter(F.col(ts) < limit)


def check_schema(declared, found) -> list[str]:
    """Differences between a declared schema and one looked up from files
    (missing / extra columns, changed types); empty when they agree."""
    d = {f.name: f.dataType for f in declared.fields}
    f_ = {f.name: f.dataType for f in found.fields}
    out = [f"missing {n}" for n in d if n not in f_]
    out += [f"extra {n}" for n in f_ if n not in d]
    out += [f"type {n}: {d[n].simpleString()} != {f_[n].simpleString()}" for n in d if n in f_ and d[n] != f_[n]]
    return out


def schema_of(spark: SparkSession, path: str):
    """Schema of existing parquet files (look-up; prefer the declared one)."""
    return spark.read.parquet(path).schema


def run_silver(spark: SparkSession, bronze_path: str, silver_path: str, checkpoint: str,
               delay: str = "24 hours", processed_at=None, max_files: int | None = None,
               max_bytes: int | None = None, trigger: str | None = "available_now",
               schema=BRONZE) -> StreamingQuery:
    """New bronze files -> silver (dedup under watermark, amount >= 0), by ``date``.

    With the default trigger it drains what is there and stops (hourly run).
    """
    src = _rate_limited(spark, schema, max_files, max_bytes).parquet(bronze_path)
    silver = to_silver(src, delay=delay, processed_at=processed_at)
    q = parquet_sink(silver, silver_path, checkpoint, ["date"], trigger)
    if trigger in (None, "available_now", "once"):
        q.awaitTermination()
    return q


def warehouse_writer(target: str | None = None, jdbc_url: str | None = None, table: str = "transactions",
                     properties: dict | None = None, writers: int = JDBC_WRITERS,
                     batch_rows: int = JDBC_BATCH_ROWS, checkpoint: str | None = None,
                     batch_column: str | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function appending a micro-batch to the warehouse.

    Parquet target: rows are laid out by (``date``, ``load_id``), so readers of
    a few days open those days only.  A load is one batch of one generation of
    the stream's ``checkpoint``; dynamic overwrite makes a repeated batch
    replace itself and leaves the loads of older checkpoints alone.
    JDBC target: empty batches are skipped with ``isEmpty`` before any
    connection opens; append with ``writers`` connections and ``batch_rows``
    per insert.  A retried batch repeats its rows unless ``batch_column`` (a
    bigint column of the table) is given: then each batch first deletes its
    own rows and appends them tagged with its id (not tested here: no database).
    """
    if not jdbc_url and not (target and checkpoint):
        raise ValueError("a parquet warehouse needs its path and the stream's checkpoint")

    def write(batch: DataFrame, batch_id: int) -> None:
        if not jdbc_url:
            # rows of a day together, large days split: not one file a task and day
            replace_load(batch.hint("rebalance", "date"), target, load_id(batch.sparkSession, checkpoint, batch_id),
                         ("date",))
            return
        if batch.isEmpty():
            return
        if batch_column:
            execute(batch.sparkSession, jdbc_url,
                    f"DELETE FROM {table} WHERE {batch_column} = {int(batch_id)}", properties)
            batch = batch.withColumn(batch_column, F.lit(batch_id).cast("long"))
        append_table(batch, jdbc_url, table, properties, writers, batch_rows)
    return write


def _rate_limited(spark: SparkSession, schema, max_files: int | None, max_bytes: int | None):
    if max_files and max_bytes:
        raise ValueError("bound a batch by max_files or by max_bytes, not by both")
    r = spark.readStream.schema(schema)
    if max_bytes:
        return r.option("maxBytesPerTrigger", int(max_bytes))
    if max_files:
        return r.option("maxFilesPerTrigger", int(max_files))
    return r


def run_warehouse(spark: SparkSession, silver_path: str, checkpoint: str,
                  writer: Callable[[DataFrame, int], None],
                  max_files: int | None = None, max_bytes: int | None = None,
                  schema=SILVER, trigger: str | None = "available_now") -> StreamingQuery:
    """New silver files -> warehouse projection -> writer, one bounded batch at a time.

    A batch is bounded by ``max_bytes`` of input or by ``max_files`` files, as
    the target needs it (``DATABASE_MAX_FILES`` protects a database); without
    a bound a drain takes what is there in one batch, which Spark splits into
    tasks like any other job.
    """
    src = _rate_limited(spark, schema, max_files, max_bytes).parquet(silver_path)
    # per-batch row count as a query metric (lastProgress.observedMetrics), no extra job
    rows = to_warehouse(src).observe("warehouse_batch", F.count(F.lit(1)).alias("rows"))
    q = (rows.writeStream.foreachBatch(writer)
         .option("checkpointLocation", checkpoint).trigger(**trigger_kwargs(trigger)).start())
    if trigger in (None, "available_now", "once"):
        q.awaitTermination()
    return q


def read_warehouse(spark: SparkSession, target: str) -> DataFrame:
    """Warehouse rows; the table is laid out by ``date``, so a day filter prunes."""
    return spark.read.parquet(target).drop("load_id")
