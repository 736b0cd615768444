"""Tables as snapshots: folders that never change, and a list of those that are current.

A draft writes each table into a folder of its own version
(``<table>/__version=V``, by ``date`` where the table has days) and nothing that
a reader may have open (no column may be called ``__version``).  A day that wasn't written again stays where an
earlier version put it.  What makes a draft visible is its list, one small
table that names the version of each day: it counts once its ``_SUCCESS`` file
is there, which is created last and at once.  So a reader, or a draft that stopped,
always has all tables of one version, whole.

Lists hold a row a table and day (bounded by the calendar, safe to collect).
One writer at a time, as a scheduled refresh is; a draft that stopped is
written over by the next.  Nothing is deleted here: ``unreferenced`` names the
folders that the last lists don't need.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

LIST = "kind string, name string, day string, number long, text string"
NULL_DAY = "__HIVE_DEFAULT_PARTITION__"
Row = tuple[str, str | None, str | None, int | None, str | None]


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, by listing."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return [f.getPath().toString() for f in found or []]


def _versions(spark: SparkSession, root: str) -> list[int]:
    marks = folders(spark, f"{root}/published/v*/_SUCCESS")
    return sorted(int(m.split("/")[-2].removeprefix("v")) for m in marks)


def _day_name(day: str | None) -> str:
    return f"date={NULL_DAY if day is None else day}"


class Snapshot:
    """The tables under ``root`` as a published version lists them (0: none yet).

    ``days``: versions of a table's days; a day may have several, whose rows
    add up.  ``whole``: versions of tables without days.  ``notes``: other rows
    published with the version, (kind, name, day, number, text).
    """

    def __init__(self, spark: SparkSession, root: str, version: int | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        known = _versions(spark, self.root)
        if version is not None and version not in known:
            raise ValueError(f"no published version {version} under {root}")
        self.version = version if version is not None else max(known, default=0)
        self.days: dict[str, dict[str | None, list[int]]] = {}
        self.whole: dict[str, int] = {}
        self.schemas: dict[str, StructType] = {}
        self.notes: list[Row] = []
        if self.version:
            for r in spark.read.schema(LIST).parquet(f"{self.root}/published/v{self.version}").collect():
                if r.kind == "day":
                    self.days.setdefault(r["name"], {}).setdefault(r.day, []).append(r.number)
                elif r.kind == "whole":
                    self.whole[r["name"]] = r.number
                elif r.kind == "schema":
                    self.schemas[r["name"]] = StructType.fromJson(json.loads(r.text))
                else:
                    self.notes.append(tuple(r))

    def paths(self, table: str) -> list[str]:
        """Folders that hold the table's current rows."""
        if table in self.whole:
            return [f"{self.root}/{table}/__version={self.whole[table]}"]
        return [f"{self.root}/{table}/__version={v}/{_day_name(d)}"
                for d, vs in self.days.get(table, {}).items() for v in vs]

    def read(self, table: str) -> DataFrame:
        """The table's rows; its schema is known and a filter on ``date`` prunes folders."""
        if table not in self.schemas:
            raise ValueError(f"no table {table} in version {self.version} of {self.root}")
        schema, paths = self.schemas[table], self.paths(table)
        if not paths:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}").parquet(*paths)
        return rows.select(*schema.names)


class Draft(Snapshot):
    """The next version: begins with what is published and is seen by readers once published.

    Tables may be written from several threads, each table by one of them.
    """

    def __init__(self, spark: SparkSession, root: str, empty: bool = False):
        super().__init__(spark, root)
        self.before = Snapshot(spark, root, self.version) if self.version else None
        self.version += 1
        self.notes = []
        if empty:
            self.days, self.whole, self.schemas = {}, {}, {}

    def write(self, df: DataFrame, table: str, days: Sequence[str | None] | None = None, add: bool = False,
              sort: Sequence[str] = ()) -> None:
        """Write rows by ``date``; they replace the table's rows of ``days`` (None: all of them).

        A replaced day without rows is a day less.  ``add``: the rows come on
        top of what the days have.  Rows of a day are together, large days
        split; ``sort`` orders them within a file.
        """
        path = f"{self.root}/{table}/__version={self.version}"
        rows = df.hint("rebalance", "date")
        if sort:
            rows = rows.sortWithinPartitions("date", *sort)
        rows.write.mode("overwrite").partitionBy("date").parquet(path)
        written = [p.rsplit("/date=", 1)[1] for p in folders(self.spark, f"{path}/date=*")]
        kept = {} if days is None and not add else {d: list(v) for d, v in self.days.get(table, {}).items()}
        for d in () if add else days or ():
            kept.pop(d, None)
        for d in (None if w == NULL_DAY else w for w in written):
            if d in kept and not add:
                raise ValueError(f"rows of {table} for {d}, which is not among the days to replace")
            kept.setdefault(d, []).append(self.version)
        self.days[table], self.schemas[table] = kept, df.schema

    def write_whole(self, df: DataFrame, table: str) -> None:
        """Write a table without days, replacing it."""
        df.write.mode("overwrite").parquet(f"{self.root}/{table}/__version={self.version}")
        self.whole[table], self.schemas[table] = self.version, df.schema

    def publish(self, notes: Iterable[Row] = ()) -> int:
        """Make the draft the current version (its last write)."""
        rows: list[Row] = [("day", t, d, v, None) for t, ds in self.days.items() for d, vs in ds.items() for v in vs]
        rows += [("whole", t, None, v, None) for t, v in self.whole.items()]
        rows += [("schema", t, None, None, s.json()) for t, s in self.schemas.items()]
        rows += list(notes)
        (self.spark.createDataFrame(rows, LIST).coalesce(1).write.mode("overwrite")
         .parquet(f"{self.root}/published/v{self.version}"))
        return self.version


def read_table(spark: SparkSession, root: str, table: str, version: int | None = None) -> DataFrame:
    """A table of the current (or a named) published version."""
    return Snapshot(spark, root, version).read(table)


def unreferenced(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Folders that none of the last ``keep`` versions lists: old days and stopped drafts.

    For the caller to remove while no draft is being written, once no reader holds an older version.
    """
    root = root.rstrip("/")
    listed = set()
    for v in _versions(spark, root)[-keep:]:
        snap = Snapshot(spark, root, v)
        for table in snap.schemas:
            listed |= {p.removeprefix(f"{root}/") for p in snap.paths(table)}
    found = []
    for p in folders(spark, f"{root}/*/__version=*"):
        name = "/".join(p.split("/")[-2:])
        if name in listed:
            continue
        inner = [f"{name}/{d.rsplit('/', 1)[1]}" for d in folders(spark, f"{root}/{name}/date=*")]
        found += [f"{root}/{n}" for n in inner or [name] if n not in listed]
    return sorted(found)
