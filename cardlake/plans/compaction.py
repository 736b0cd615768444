"""Compaction of the warehouse: many small loads of a day become few files, sorted.

The stream lays each load of a day into a folder of its own, so a day that
receives rows every hour is hundreds of small files.  ``compact`` packs them:
the parts of a day that are smaller than ``target_bytes`` are rewritten as one
part once there are more than ``max_parts`` of them; larger parts are left
alone.  So a day has at most ``max_parts`` small parts beside its full ones,
and a row is rewritten only until its part is full.

Parts are a snapshot (``plans.snapshots``) beside the warehouse, which also
notes up to which batch of each stream generation the loads of a day are in
it.  ``read_compacted`` reads the parts and the loads that came later, so a
reader sees each row once at any time, also when a compaction stops anywhere.
Run it between drains, as the hourly refresh does: a load that the stream is
still writing, or writes again, must not be packed.  Nothing is deleted;
``packed_loads`` names the load folders that no reader needs any more.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from cardlake.plans.snapshots import NULL_DAY, Draft, Snapshot, folders

PARTS = "transactions"
TARGET_BYTES = 128 * 1024 * 1024
MAX_PARTS = 24
SORT = ("event_ts", "transaction_id")


@dataclass
class DayPlan:
    """What a compaction does to a day: parts and loads that become one part, parts that stay."""
    loads: list[tuple[str, int]] = field(default_factory=list)      # (stream generation, batch)
    small: list[int] = field(default_factory=list)                  # versions of parts
    full: list[int] = field(default_factory=list)


def _parts_path(path: str) -> str:
    return f"{path.rstrip('/')}-parts"


def _packed(snap: Snapshot) -> dict[tuple[str | None, str], int]:
    """(day, stream generation) -> last batch that the parts contain."""
    return {(day, name): number for kind, name, day, number, _ in snap.notes if kind == "packed"}


def _day_of(folder: str) -> str | None:
    name = folder.rsplit("/date=", 1)[1].split("/")[0]
    return None if name == NULL_DAY else name


def _load_of(folder: str) -> tuple[str, int]:
    generation, batch = folder.rsplit("/load_id=", 1)[1].rsplit("-", 1)
    return generation, int(batch)


def warehouse_loads(spark: SparkSession, path: str) -> list[tuple[str | None, str, int]]:
    """(date, stream generation, batch) of each load of a day in the warehouse: a listing of
    folders, bounded by the calendar and the loads; no file is opened."""
    return [(_day_of(f), *_load_of(f)) for f in folders(spark, f"{path.rstrip('/')}/date=*/load_id=*")]


def _load_folder(path: str, day: str | None, load: tuple[str, int]) -> str:
    return f"{path.rstrip('/')}/date={NULL_DAY if day is None else day}/load_id={load[0]}-{load[1]:09d}"


def _sizes(spark: SparkSession, pattern: str) -> dict[str, int]:
    """Bytes of the files in each folder that matches, by listing."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{pattern}/*.parquet")
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    sizes: dict[str, int] = {}
    for f in found or []:
        folder = f.getPath().getParent().toString()
        sizes[folder] = sizes.get(folder, 0) + f.getLen()
    return sizes


def plan_compaction(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES,
                    max_parts: int = MAX_PARTS) -> dict[str | None, DayPlan]:
    """The days that have more than ``max_parts`` parts smaller than ``target_bytes``.

    A load that hasn't been packed is a part, whatever its size, and is packed
    with its day.  Read from listings alone.
    """
    snap = Snapshot(spark, _parts_path(path))
    packed = _packed(snap)
    days: dict[str | None, DayPlan] = {}
    for day, generation, batch in warehouse_loads(spark, path):
        if batch > packed.get((day, generation), -1):
            days.setdefault(day, DayPlan()).loads.append((generation, batch))
    sizes = {(_day_of(f), int(f.rsplit("/__version=", 1)[1].split("/")[0])): n
             for f, n in _sizes(spark, f"{snap.root}/{PARTS}/__version=*/date=*").items()}
    for day, versions in snap.days.get(PARTS, {}).items():
        plan = days.get(day)
        for v in versions if plan else ():
            (plan.small if sizes.get((day, v), 0) < target_bytes else plan.full).append(v)
    return {d: p for d, p in days.items() if len(p.loads) + len(p.small) > max_parts}


def compact(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES, max_parts: int = MAX_PARTS) -> int:
    """Rewrite the days that ``plan_compaction`` names; returns their number.

    Rows of a day come together (a large day is split into files of the
    session's advisory partition size) and are sorted by event time within a
    file, so a filter on time skips row groups.
    """
    plan = plan_compaction(spark, path, target_bytes, max_parts)
    if not plan:
        return 0
    draft, chosen = Draft(spark, _parts_path(path)), Snapshot(spark, _parts_path(path))
    chosen.days[PARTS] = {d: p.small for d, p in plan.items() if p.small}
    loads = [_load_folder(path, d, load) for d, p in plan.items() for load in p.loads]
    rows = _read_loads(spark, path, loads, chosen.schemas.get(PARTS))
    if chosen.days[PARTS]:
        rows = chosen.read(PARTS).unionByName(rows)
    kept = draft.days.setdefault(PARTS, {})
    for d, p in plan.items():
        kept[d] = list(p.full)
    draft.write(rows, PARTS, add=True, sort=SORT)
    packed = _packed(draft.before) if draft.before else {}
    for d, p in plan.items():
        for generation, batch in p.loads:
            packed[d, generation] = max(batch, packed.get((d, generation), -1))
    draft.publish([("packed", g, d, b, None) for (d, g), b in packed.items()])
    return len(plan)


def _read_loads(spark: SparkSession, path: str, loads: list[str], schema=None) -> DataFrame:
    reader = spark.read.option("basePath", path)
    if schema is not None:
        reader = reader.schema(schema)
    rows = reader.parquet(*loads).drop("load_id")
    return rows if schema is None else rows.select(*schema.names)


def read_compacted(spark: SparkSession, path: str) -> DataFrame:
    """Warehouse rows: the parts and the loads that aren't in them; a day filter prunes both."""
    snap = Snapshot(spark, _parts_path(path))
    if PARTS not in snap.schemas:
        return spark.read.parquet(path).drop("load_id")
    packed = _packed(snap)
    fresh = [_load_folder(path, d, (g, b)) for d, g, b in warehouse_loads(spark, path) if b > packed.get((d, g), -1)]
    parts = snap.read(PARTS)
    return parts.unionByName(_read_loads(spark, path, fresh, snap.schemas[PARTS])) if fresh else parts


def packed_loads(spark: SparkSession, path: str) -> list[str]:
    """Load folders whose rows the parts contain, for the caller to remove when no reader of
    an earlier version is left."""
    packed = _packed(Snapshot(spark, _parts_path(path)))
    return [_load_folder(path, d, (g, b)) for d, g, b in warehouse_loads(spark, path) if b <= packed.get((d, g), -1)]
