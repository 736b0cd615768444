"""Compaction: rows and files after many loads, what stays, what a stop leaves, days without a date."""

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from cardlake.plans.compaction import compact, packed_loads, plan_compaction, read_compacted, warehouse_loads
from cardlake.plans.snapshots import Snapshot

DAYS = ["2024-01-01", "2024-01-02", None]


def _deliver(spark, path, loads, days=DAYS, generation="g1"):
    """Five rows a load and day, in one write; a row's number tells its load."""
    rows = spark.range(5 * len(loads)).select(
        F.col("id").alias("transaction_id"), F.lit("2024-01-01").cast("timestamp").alias("event_ts"),
        F.element_at(F.array(*[F.lit(x) for x in loads]), (F.col("id") / 5).cast("int") + 1).alias("n"))
    rows = rows.withColumn("d", F.explode(F.array(*[F.lit(d) for d in days]))).select(
        "transaction_id", F.expr("event_ts + make_interval(0, 0, 0, 0, 0, 100 - n)").alias("event_ts"), "n",
        F.col("d").cast("date").alias("date"),
        F.concat(F.lit(f"{generation}-"), F.lpad(F.col("n").cast("string"), 9, "0")).alias("load_id"))
    rows.coalesce(1).write.mode("append").partitionBy("date", "load_id").parquet(path)


def _counts(df):
    return {(str(r[0]) if r[0] else None): tuple(r)[1:] for r in
            df.withColumn("f", F.input_file_name()).groupBy("date")
            .agg(F.count("*"), F.countDistinct("n"), F.countDistinct("f")).collect()}


def test_rows_stay_and_files_are_few(spark, tmp_root):
    path = f"{tmp_root}/wh"
    _deliver(spark, path, list(range(50)))
    assert _counts(read_compacted(spark, path)) == {d: (250, 50, 50) for d in DAYS}
    assert compact(spark, path, max_parts=50) == 0
    assert compact(spark, path) == 3
    assert _counts(read_compacted(spark, path)) == {d: (250, 50, 1) for d in DAYS}
    part = read_compacted(spark, path).filter("date = date'2024-01-02'")
    assert "PartitionFilters: [isnotnull(date" in part._jdf.queryExecution().executedPlan().toString()
    times = [r.event_ts for r in part.collect()]
    assert times == sorted(times)
    # later loads stand beside the part, of another generation too, and are packed with it when they are many
    _deliver(spark, path, [50, 51], DAYS[:1])
    _deliver(spark, path, [0, 1, 2], DAYS[:1], "g2")
    assert _counts(read_compacted(spark, path))[DAYS[0]] == (275, 52, 6)
    assert compact(spark, path, max_parts=6) == 0 and compact(spark, path, max_parts=5) == 1
    assert _counts(read_compacted(spark, path)) == {DAYS[0]: (275, 52, 1), DAYS[1]: (250, 50, 1), None: (250, 50, 1)}
    assert len(packed_loads(spark, path)) == len(warehouse_loads(spark, path)) == 155
    # a full part is left alone
    _deliver(spark, path, [52, 53], DAYS[:1])
    assert compact(spark, path, target_bytes=1, max_parts=1) == 1
    assert _counts(read_compacted(spark, path))[DAYS[0]] == (285, 54, 2)
    assert [len(v) for v in Snapshot(spark, f"{path}-parts").days["transactions"].values()].count(2) == 1


def test_a_compaction_that_stops_changes_nothing(spark, tmp_root, monkeypatch):
    path = f"{tmp_root}/wh"
    _deliver(spark, path, list(range(4)))
    write, calls = DataFrameWriter.parquet, []

    def failing(self, target, *a, **kw):
        calls.append(target)
        if len(calls) > 1:      # the part is written, its list isn't
            raise RuntimeError("stopped")
        return write(self, target, *a, **kw)
    with monkeypatch.context() as m:
        m.setattr(DataFrameWriter, "parquet", failing)
        with pytest.raises(RuntimeError, match="stopped"):
            compact(spark, path, max_parts=2)
    assert _counts(read_compacted(spark, path)) == {d: (20, 4, 4) for d in DAYS} and packed_loads(spark, path) == []
    assert compact(spark, path, max_parts=2) == 3
    assert _counts(read_compacted(spark, path)) == {d: (20, 4, 1) for d in DAYS}


def test_no_warehouse_yet(spark, tmp_root):
    assert plan_compaction(spark, f"{tmp_root}/none") == {} and compact(spark, f"{tmp_root}/none") == 0
