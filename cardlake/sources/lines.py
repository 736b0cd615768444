"""Raw payload sources: broker topic or text files with one JSON per line.

Both give one ``value`` column, so the parse step is the same for either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_stream(spark: SparkSession, servers: str, topic: str,
                 starting_offsets: str = "latest", fail_on_data_loss: bool = True,
                 max_offsets_per_trigger: int | None = None,
                 min_partitions: int | None = None) -> DataFrame:
    """Streaming read of a broker topic (needs the spark-sql-kafka package).

    Starting point and behaviour on expired offsets default to the source's
    own: going on after a loss is the caller's choice.
    ``max_offsets_per_trigger`` bounds a micro-batch, and with it the rows
    of one card that the keyed state function sees at once.
    ``min_partitions`` splits the offset ranges of a few topic partitions
    into at least that many read tasks (a 3-partition topic would otherwise
    be read by 3 tasks however large the cluster).
    """
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets)
         .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", int(max_offsets_per_trigger))
    if min_partitions:
        r = r.option("minPartitions", int(min_partitions))
    return r.load()


def text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of newline-delimited payload files (``value`` column)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.load(path)


def write_lines(lines: DataFrame, path: str, mode: str = "append") -> None:
    """Deliver payloads as text files (a stand-in for producing to a topic)."""
    lines.select("value").write.mode(mode).text(path)
