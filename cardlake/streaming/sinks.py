"""Streaming sinks and triggers (parquet files, broker topic, drains)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def trigger_kwargs(trigger: str | None) -> dict:
    """'available_now' (drain and stop), 'once', or a processing interval."""
    if trigger in (None, "available_now"):
        return {"availableNow": True}
    if trigger == "once":
        return {"once": True}
    return {"processingTime": trigger}


def parquet_sink(df: DataFrame, path: str, checkpoint: str,
                 partition_by: Sequence[str] = (), trigger: str | None = None,
                 name: str | None = None) -> StreamingQuery:
    """Append-only parquet files; the sink's log makes it exactly-once."""
    w = (df.writeStream.format("parquet").outputMode("append")
         .option("path", path).option("checkpointLocation", checkpoint)
         .trigger(**trigger_kwargs(trigger)))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if name:
        w = w.queryName(name)
    return w.start()


def kafka_sink(df: DataFrame, servers: str, topic: str, checkpoint: str,
               trigger: str | None = None) -> StreamingQuery:
    """``key``/``value`` rows to a broker topic (needs the spark-sql-kafka package)."""
    return (df.writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger_kwargs(trigger)).start())


def drain(df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Run ``df`` to completion into parquet at ``path``; return what was written."""
    q = parquet_sink(df, path, checkpoint, partition_by, trigger="available_now")
    q.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path) if not partition_by \
        else df.sparkSession.read.parquet(path)
