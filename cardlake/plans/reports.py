"""Daily CSV reports and bronze retention (jobs over mart / bronze frames)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.plans.incremental import _in_days


def day_text(as_of) -> str:
    if isinstance(as_of, (dt.date, dt.datetime)):
        return as_of.strftime("%Y-%m-%d")
    return str(as_of)[:10]


def report_day(mart: DataFrame, as_of) -> DataFrame:
    """Rows of one day (``date = as_of``); prunes a date-partitioned mart."""
    return mart.filter(F.col("date") == F.lit(day_text(as_of)).cast("date"))


def export_report(mart: DataFrame, as_of, path: str, prefix: str = "settlement",
                  files: int | None = None) -> str:
    """Write one day's rows as CSV with a header to ``path/<prefix>_<day>``.

    One ``as_of`` gives both the filter and the folder name.  ``files``
    reduces the writers after the day filter (``1`` = one file, as the
    reference does); by default Spark's partitioning is kept so a large day
    is not funnelled through one task.  Overwrites that day's folder only.
    """
    out = f"{path.rstrip('/')}/{prefix}_{day_text(as_of)}"
    day = report_day(mart, as_of)
    if files:
        day = day.coalesce(files)
    day.write.mode("overwrite").option("header", True).csv(out)
    return out


def read_report(spark, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def retention_candidates(bronze: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Bronze rows of days older than ``days`` before ``as_of`` (partition pruned)."""
    cutoff = F.date_sub(F.lit(day_text(as_of)).cast("date"), days)
    return bronze.filter(F.col("date") < cutoff)


DIGEST = "date date, bucket int, n long, h decimal(38,0), g decimal(38,0)"
DIGEST_BUCKETS = 64


def _bucket(columns: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int").alias("bucket")


def day_digests(rows: DataFrame, columns: list[str], buckets: int = DIGEST_BUCKETS) -> DataFrame:
    """(date, bucket, n, h, g): digests of the multisets of rows per day and hash bucket.

    Sums of two independent hashes, so the order of rows doesn't matter and
    digests of parts add up; they combine map-side, no row is shuffled.
    """
    h, g = (F.sum(f(*columns).cast("decimal(38,0)")) for f in (F.xxhash64, lambda *c: F.xxhash64(F.lit(1), *c)))
    return (rows.withColumn("bucket", _bucket(columns, buckets)).groupBy("date", "bucket")
            .agg(F.count(F.lit(1)).alias("n"), h.alias("h"), g.alias("g")))


def _names(spark: SparkSession, pattern: str) -> set[str]:
    """Last names of the paths that match, by listing."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return {f.getPath().getName() for f in found or []}


def _digest_path(archive_path: str) -> str:
    return f"{archive_path.rstrip('/')}-digests"


def _write_digests(spark: SparkSession, archive_path: str, run: str, columns: list[str]) -> None:
    """Digests of what the archive holds of a run (reads that run's partitions only)."""
    rows = spark.read.parquet(archive_path).filter(F.col("run_id") == F.lit(run))
    (day_digests(rows, columns).select("date", "bucket", "n", "h", "g").coalesce(1)
     .write.mode("overwrite").parquet(f"{_digest_path(archive_path)}/run={run}"))


def differing_buckets(candidates: DataFrame, archive_path: str, run_id: str) -> DataFrame:
    """(date, bucket) in which the candidates aren't what the other runs have archived of them."""
    spark = candidates.sparkSession
    columns = candidates.columns
    runs = {n.removeprefix("run_id=") for n in _names(spark, f"{archive_path.rstrip('/')}/*/run_id=*")} - {run_id}
    done = {n.removeprefix("run=") for n in _names(spark, f"{_digest_path(archive_path)}/run=*")}
    for run in sorted(runs - done):   # a run that stopped before its digests were written
        _write_digests(spark, archive_path, run, columns)
    mine = day_digests(candidates, columns)
    paths = [f"{_digest_path(archive_path)}/run={r}" for r in sorted(runs)]
    held = spark.read.schema(DIGEST).parquet(*paths) if paths else spark.createDataFrame([], DIGEST)
    held = held.groupBy("date", "bucket").agg(*[F.sum(c).alias(f"{c}2") for c in "nhg"]).withColumnsRenamed(
        {"date": "date2", "bucket": "bucket2"})
    same = (F.col("n") == F.col("n2")) & (F.col("h") == F.col("h2")) & (F.col("g") == F.col("g2"))
    return (mine.join(held, F.col("date").eqNullSafe(F.col("date2")) & (F.col("bucket") == F.col("bucket2")), "left")
            .where(~F.coalesce(same, F.lit(False))).select("date", "bucket"))


def new_rows(candidates: DataFrame, archive_path: str, run_id: str) -> DataFrame:
    """Rows of the candidates that the archive's other runs don't hold, copy for copy.

    Digests are compared first; archived rows are read of the differing days only.
    """
    spark, columns = candidates.sparkSession, candidates.columns
    if not _names(spark, f"{archive_path.rstrip('/')}/*/run_id=*"):
        return candidates
    buckets = [(r[0], r[1]) for r in differing_buckets(candidates, archive_path, run_id).collect()]  # days x buckets at most
    days = [None if d is None else str(d) for d in {d for d, _ in buckets}]
    differ = spark.createDataFrame(buckets, "d date, b int")

    def touched(rows: DataFrame) -> DataFrame:
        rows = _in_days(rows, days).withColumn("_b", _bucket(columns, DIGEST_BUCKETS))
        return rows.join(differ, F.col("date").eqNullSafe(F.col("d")) & (F.col("_b") == F.col("b")), "left_semi").select(*columns)
    held = spark.read.parquet(archive_path).filter(F.col("run_id") != F.lit(run_id))
    return touched(candidates).exceptAll(touched(held.select(*columns)))


def archive_partitions(candidates: DataFrame, archive_path: str, run_id: str) -> None:
    """Add old days to an archive table, laid out by (``date``, ``run_id``).

    Only rows that the archive of those days doesn't hold yet are written
    (copy for copy), so a later run that brings late rows of an archived day
    adds them and repeats none; nothing archived is replaced but an earlier
    try of the same run.  Nothing is deleted from bronze.  What a run has
    written is kept as digests beside the archive, written last: days that
    are whole are recognised without reading them again, and a run that stopped before its
    digests is read once by the next.
    """
    spark = candidates.sparkSession
    fresh = new_rows(candidates, archive_path, run_id)
    (fresh.withColumn("run_id", F.lit(run_id)).hint("rebalance", "date")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("date", "run_id").parquet(archive_path))
    if _names(spark, f"{archive_path.rstrip('/')}/*/run_id={run_id}"):
        _write_digests(spark, archive_path, run_id, candidates.columns)
