"""Ids that were loaded before, in buckets, so that a load is checked without moving history.

The index is a bucketed parquet table (key, load_id, n): n rows of that key came
with that load.  History is laid out by the hash of the key once, when it is
written; a check shuffles the load alone (or broadcasts its keys, where they
are measured small) and reads history's buckets as they lie.  What is known of
a load's keys is then as small as the load.

* ``first_seen``: the rows of a load whose key no earlier load had, one for each
  key; this holds however far behind the watermark a backfill reaches.
* ``repeated``: keys of a load that occur more than once in all loads so far.
* ``duplicates``: how many rows of a load repeat a key, for a profile that grows by loads.
* ``add``: enters a load; entering it again changes nothing, and a load that is
  checked again doesn't see itself.

Null keys are never known and never repeated, and every row with one is passed
on.  Equal rows of a load are copies: one stays.  One writer at a time.  The
session's catalog only names the folder; buckets are part of the file names, so
another session opens the same index with the same ``path``.  The number of
``buckets`` is kept with the index and cannot change; each load adds at most one
file a bucket, ``compacted`` writes them together into a new folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64


class KeyIndex:
    def __init__(self, spark: SparkSession, path: str, key: str = "transaction_id",
                 key_type: str = "string", buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.key_type = spark, path.rstrip("/"), key, key_type
        facts = f"{self.path}/_layout"
        fs, p = _folder(spark, facts)
        if fs.exists(p):
            kept = spark.read.text(facts).first()[0].split(" ")
            if kept[0] != key_type:
                raise ValueError(f"the index at {path} has keys of type {kept[0]}, not {key_type}")
            buckets = int(kept[1])
        else:
            spark.createDataFrame([(f"{key_type} {buckets}",)], "value string").coalesce(1).write.text(facts)
        self.buckets = buckets
        self.table = f"key_index_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE {self.table} (k {key_type}, load_id STRING, n BIGINT) USING parquet "
                  f"CLUSTERED BY (k) SORTED BY (k) INTO {int(buckets)} BUCKETS LOCATION '{self.path}/keys'")

    def rows(self) -> DataFrame:
        """(k, load_id, n) of all loads."""
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def _counts(self, load: DataFrame) -> DataFrame:
        """(k, n): keys of a load with their rows; a hot key is combined in each task."""
        return (load.select(F.col(self.key).cast(self.key_type).alias("k")).where("k IS NOT NULL")
                .groupBy("k").agg(F.count(F.lit(1)).alias("n")))

    def known(self, load: DataFrame, load_id: str) -> DataFrame:
        """(k, n): the keys of a load that earlier loads had, with their rows there."""
        keys = self._counts(load).select(F.col("k").alias("_k"))
        past = self.rows().where(F.col("load_id") != load_id)
        return (past.join(keys, past["k"] == keys["_k"], "left_semi")
                .groupBy("k").agg(F.sum("n").alias("n")))

    def first_seen(self, load: DataFrame, load_id: str, order: Sequence[str] | None = None) -> DataFrame:
        """Rows of the load with a new key; of copies the first by ``order`` (default: by all columns)."""
        past = self.known(load, load_id).select(F.col("k").alias("_k"))
        keyed = load.withColumn("_key", F.col(self.key).cast(self.key_type))
        new = keyed.where("_key IS NOT NULL").join(past, F.col("_key") == F.col("_k"), "left_anti")
        # min of a struct is combined in each task, so a key with many copies is no hot one
        by = [F.col(c) for c in (load.columns if order is None else order)]
        row = F.struct(*[F.col(c) for c in load.columns])
        one = new.groupBy("_key").agg(F.min_by(row, F.struct(*by)).alias("_row")).select("_row.*")
        return one.unionByName(keyed.where("_key IS NULL").select(*load.columns))

    def repeated(self, load: DataFrame, load_id: str) -> DataFrame:
        """(key, n): keys of the load that now occur more than once, with all their rows."""
        return (self._counts(load).unionByName(self.known(load, load_id)).groupBy("k").agg(F.sum("n").alias("n"))
                .where("n > 1").select(F.col("k").alias(self.key), "n"))

    def duplicates(self, load: DataFrame, load_id: str) -> int:
        """Rows of the load whose key is one that an earlier load or row had: a number, summed
        over loads the non-null key rows minus the distinct keys."""
        counts = self._counts(load)
        known = self.known(load, load_id).select(F.col("k").alias("_k"), F.lit(1).alias("_known"))
        seen = counts.join(known, counts["k"] == known["_k"], "left")
        return seen.agg(F.sum(F.col("n") - F.when(F.col("_known").isNull(), 1).otherwise(0))).first()[0] or 0

    def add(self, load: DataFrame, load_id: str) -> None:
        """Enter the keys of a load; keys that are there for this load already stay as they are."""
        mine = self.rows().where(F.col("load_id") == load_id).select(F.col("k").alias("_k"))
        counts = self._counts(load)
        self._insert(counts.join(mine, counts["k"] == mine["_k"], "left_anti")
                     .select("k", F.lit(load_id).alias("load_id"), "n"))

    def _insert(self, rows: DataFrame) -> None:
        # by bucket number: a repartition by ``k`` is dropped over rows that lie by ``k`` already
        (rows.repartition(self.buckets, F.pmod(F.hash("k"), F.lit(self.buckets)))
         .write.insertInto(self.table))

    def compacted(self, path: str) -> KeyIndex:
        """The same index at a new path, one sorted file a bucket."""
        other = KeyIndex(self.spark, path, self.key, self.key_type, self.buckets)
        other._insert(self.rows())
        return other


def _folder(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p
