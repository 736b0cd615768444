"""The reference's two scheduled flows as plain functions (no scheduler).

hourly_refresh: bronze -> silver -> warehouse -> models, in that order, each
step draining what is new since its checkpoint.  daily_reports: settlement and
fraud reports for one day from the written marts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cardlake.plans.build import build_models
from cardlake.plans.compaction import MAX_PARTS, compact, read_compacted, warehouse_loads
from cardlake.plans.incremental import published, refresh_models
from cardlake.plans.reports import export_report
from cardlake.streaming.jobs import run_silver, run_warehouse, warehouse_writer


@dataclass(frozen=True)
class LakePaths:
    """Folders of one deployment (all on the shared file system)."""
    root: str

    def _at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    bronze = property(lambda self: self._at("bronze"))
    silver = property(lambda self: self._at("silver"))
    warehouse = property(lambda self: self._at("warehouse"))
    models = property(lambda self: self._at("models"))
    reports = property(lambda self: self._at("reports"))
    chk = property(lambda self: self._at("chk"))


def hourly_refresh(spark: SparkSession, paths: LakePaths, processed_at=None,
                   silver_max_bytes: int | None = None, warehouse_max_bytes: int | None = None,
                   warehouse_max_files: int | None = None, incremental: bool = True,
                   compact_after: int | None = MAX_PARTS) -> dict[str, DataFrame]:
    """Silver and warehouse drains, compaction of the warehouse's days that have
    more than ``compact_after`` small parts (None: never), then the models.

    ``incremental``: only the days of warehouse loads not yet covered by a
    published refresh are re-read (``plans.incremental``), so a refresh that
    stopped anywhere is made up for by the next one.  ``False`` rebuilds every
    model in full.
    """
    run_silver(spark, paths.bronze, paths.silver, f"{paths.chk}/silver", processed_at=processed_at,
               max_bytes=silver_max_bytes)
    checkpoint = f"{paths.chk}/warehouse"
    run_warehouse(spark, paths.silver, checkpoint, warehouse_writer(paths.warehouse, checkpoint=checkpoint),
                  max_files=warehouse_max_files, max_bytes=warehouse_max_bytes)
    if compact_after is not None:
        compact(spark, paths.warehouse, max_parts=compact_after)
    wh = read_compacted(spark, paths.warehouse)
    if not incremental:
        return build_models(wh, out_path=paths.models)
    version, done, _ = published(spark, paths.models)
    loads = warehouse_loads(spark, paths.warehouse)
    covered: dict[str, int] = dict(done)    # folders of packed loads may be gone by now
    for _, generation, batch in loads:
        covered[generation] = max(batch, covered.get(generation, -1))
    last = dict(done)
    days = sorted({d for d, g, b in loads if b > last.get(g, -1)}, key=str) if version else None
    return refresh_models(wh, paths.models, days, loads=sorted(covered.items()))


def daily_reports(models: dict[str, DataFrame], as_of, paths: LakePaths,
                  files: int | None = None) -> dict[str, str]:
    """Settlement first, then fraud (as the daily schedule runs them)."""
    return {
        "settlement": export_report(models["mart_settlement_daily"], as_of,
                                    f"{paths.reports}/settlement_daily", "settlement", files),
        "fraud": export_report(models["mart_fraud_settlement_daily"], as_of,
                               f"{paths.reports}/fraud_daily", "fraud", files),
    }
