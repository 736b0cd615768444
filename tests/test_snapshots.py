"""Snapshots: days of several versions, replaced and vanished days, stopped drafts, folders no longer needed."""

import datetime as dt

import pytest

from cardlake.plans.build import build_models
from cardlake.plans.snapshots import Draft, Snapshot, read_table, unreferenced

SCHEMA = "date date, v long"


def _rows(spark, *rows):
    return spark.createDataFrame([(None if d is None else dt.date(2024, 1, d), v) for d, v in rows], SCHEMA)


def _got(df):
    return sorted([(r.date.day if r.date else None, r.v) for r in df.collect()], key=str)


def test_days_replace_add_and_vanish(spark, tmp_root):
    root = f"{tmp_root}/s"
    assert Snapshot(spark, root).version == 0
    with pytest.raises(ValueError, match="no table"):
        read_table(spark, root, "t")
    d = Draft(spark, root)
    d.write(_rows(spark, (1, 10), (2, 20), (None, 5)), "t")
    d.write_whole(spark.range(3).selectExpr("id v"), "w")
    d.publish([("load", "g", None, 4, None)])
    held = read_table(spark, root, "t")
    d = Draft(spark, root)
    d.write(_rows(spark, (2, 21)), "t", ["2024-01-02", None])       # the rows without a date are gone
    assert _got(read_table(spark, root, "t")) == [(1, 10), (2, 20), (None, 5)]   # not published
    d.publish()
    assert _got(read_table(spark, root, "t")) == [(1, 10), (2, 21)]
    assert _got(held) == _got(read_table(spark, root, "t", version=1)) == [(1, 10), (2, 20), (None, 5)]
    assert Snapshot(spark, root).notes == [] and Snapshot(spark, root, 1).notes == [("load", "g", None, 4, None)]
    assert read_table(spark, root, "w").count() == 3                # carried over
    d = Draft(spark, root)
    d.write(_rows(spark, (2, 22), (3, 30)), "t", add=True)
    d.publish()
    assert _got(read_table(spark, root, "t")) == [(1, 10), (2, 21), (2, 22), (3, 30)]
    with pytest.raises(ValueError, match="not among the days"):
        Draft(spark, root).write(_rows(spark, (1, 1)), "t", ["2024-01-02"])
    with pytest.raises(ValueError, match="no published version"):
        read_table(spark, root, "t", version=9)


def test_empty_tables_clashing_names_and_pruning(spark, tmp_root):
    root = f"{tmp_root}/s"
    d = Draft(spark, root)
    d.write(_rows(spark), "none")
    d.write_whole(spark.createDataFrame([], SCHEMA), "empty")
    d.write(_rows(spark, (1, 1), (2, 2)).selectExpr("v version", "date", "v"), "t")     # a column named as the folders
    d.publish()
    assert read_table(spark, root, "none").columns == ["date", "v"] and read_table(spark, root, "none").count() == 0
    assert read_table(spark, root, "empty").count() == 0
    t = read_table(spark, root, "t")
    assert sorted(map(tuple, t.select("version", "v").collect())) == [(1, 1), (2, 2)]
    plan = t.filter("date = date'2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_folders_no_longer_needed(spark, tmp_root):
    root = f"{tmp_root}/s"
    for rows, days in ((((1, 1), (2, 2)), None), (((2, 3),), ["2024-01-02"]), (((2, 4),), ["2024-01-02"])):
        d = Draft(spark, root)
        d.write(_rows(spark, *rows), "t", days)
        d.write_whole(spark.range(1), "w")
        d.publish()
    Draft(spark, root).write_whole(spark.range(1), "w")             # stopped before its list
    name = lambda ps: [p.removeprefix(f"{root}/") for p in ps]      # noqa: E731
    assert name(unreferenced(spark, root, keep=1)) == ["t/__version=1/date=2024-01-02", "t/__version=2/date=2024-01-02",
                                                       "w/__version=1", "w/__version=2", "w/__version=4"]
    assert name(unreferenced(spark, root, keep=3)) == ["w/__version=4"]


def test_a_full_rebuild_leaves_readers_their_models(spark, tmp_root):
    from cardlake.operators import layers, rules
    from cardlake.sources import fixtures
    from tests.conftest import SMOKE
    wh = layers.to_warehouse(layers.with_processed_at(rules.flag_stateless(fixtures.payments(spark, SMOKE)),
                                                      "2024-02-01 00:00:00"))
    root = f"{tmp_root}/models"
    build_models(wh.filter("date < date'2024-01-03'"), out_path=root)
    held = read_table(spark, root, "mart_fraud_rate")
    n = held.count()
    build_models(wh, out_path=root)
    assert held.count() == n < read_table(spark, root, "mart_fraud_rate").count()
