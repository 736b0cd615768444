"""Several sinks from one pass over each micro-batch, each committed once.

A batch is read and prepared (parsed, flagged) once, kept, and handed to every
sink.  A ledger beside the stream's checkpoint holds an empty file for each
sink that has the batch.  When a batch is run again after a stop, sinks in the
ledger are left alone and the others are written: a file sink that stopped
half way replaces its own load (``card_batches.replace_load``); a topic may
get letters again only if the stop fell between the send and its entry.  Only
the last batch of a stream can be run again, so entries of the one before the
last are removed.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from cardlake.streaming.card_batches import load_id

Sink = tuple[Callable[[DataFrame], DataFrame], Callable[[DataFrame, str], None]]


def _folder(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def committed(spark: SparkSession, checkpoint: str, load: str) -> set[str]:
    """Names of the sinks that have the load."""
    fs, p = _folder(spark, f"{checkpoint.rstrip('/')}/ledger/{load}/*")
    return {f.getPath().getName() for f in fs.globStatus(p) or []}


def commit(spark: SparkSession, checkpoint: str, load: str, sink: str) -> None:
    fs, p = _folder(spark, f"{checkpoint.rstrip('/')}/ledger/{load}/{sink}")
    fs.create(p, True).close()


def fanout_writer(prepare: Callable[[DataFrame], DataFrame], sinks: Mapping[str, Sink],
                  checkpoint: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function.

    ``sinks``: name -> (rows of the sink out of the prepared batch, function that
    writes them as a load).  Sinks are written in the order given.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        load = load_id(spark, checkpoint, batch_id)
        todo = [name for name in sinks if name not in committed(spark, checkpoint, load)]
        if not todo:
            return
        rows = prepare(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for name in todo:
                route, put = sinks[name]
                put(route(rows), load)
                commit(spark, checkpoint, load, name)
        finally:
            rows.unpersist()
        if batch_id > 1:
            fs, old = _folder(spark, f"{checkpoint.rstrip('/')}/ledger/{load_id(spark, checkpoint, batch_id - 2)}")
            fs.delete(old, True)

    return write
