"""Command-line entry points for spark-submit (one per scheduled job).

    spark-submit run_job.py ingest  --root R --lines DIR | --kafka HOST:PORT --topic T
    spark-submit run_job.py refresh --root R
    spark-submit run_job.py report  --root R --as-of 2024-01-15

The session comes from spark-submit (master, resources, checkpoint folder);
``--root`` is the lake folder on the shared file system (bronze, silver,
warehouse, models, reports and stream checkpoints live under it).
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from cardlake.plans.refresh import LakePaths, daily_reports, hourly_refresh
from cardlake.plans.snapshots import read_table
from cardlake.session import ensure_checkpoint_dir
from cardlake.sources.lines import kafka_stream, text_stream
from cardlake.streaming.jobs import (await_any, start_card_rules_ingest, start_ingest,
                                     start_routed_ingest)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="cardlake")
    sub = p.add_subparsers(dest="job", required=True)
    ing = sub.add_parser("ingest", help="raw payloads -> bronze + dead letter (runs until stopped)")
    ing.add_argument("--root", required=True)
    ing.add_argument("--variant", choices=["bronze", "routed", "card-rules"], default="bronze")
    ing.add_argument("--one-pass", action="store_true", help="routed: one read and parse a batch for all sinks")
    ing.add_argument("--lines", help="folder of newline-delimited JSON payload files")
    ing.add_argument("--kafka", help="bootstrap servers")
    ing.add_argument("--topic", default="payments.raw")
    ing.add_argument("--dlq-topic", default="payments.deadletter")
    ing.add_argument("--trigger", default=None, help="interval, or 'available_now' to drain and stop")
    ing.add_argument("--max-offsets", type=int, default=None, help="rows of a topic batch")
    ing.add_argument("--max-files", type=int, default=None, help="files of a folder batch")
    ing.add_argument("--min-partitions", type=int, default=None, help="read tasks of a topic batch")
    ing.add_argument("--starting-offsets", default="latest", help="where a new topic checkpoint begins")
    ing.add_argument("--allow-data-loss", action="store_true",
                     help="go on when offsets have expired instead of failing")
    ref = sub.add_parser("refresh", help="bronze -> silver -> warehouse -> models (drains and stops)")
    ref.add_argument("--root", required=True)
    ref.add_argument("--silver-max-bytes", type=int, default=None)
    ref.add_argument("--warehouse-max-bytes", type=int, default=None)
    rep = sub.add_parser("report", help="daily settlement and fraud CSV reports")
    rep.add_argument("--root", required=True)
    rep.add_argument("--as-of", default=None, help="report day (default: yesterday, UTC)")
    rep.add_argument("--files", type=int, default=None)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"cardlake-{args.job}").getOrCreate()
    ensure_checkpoint_dir(spark)   # refresh and ingest cut lineage there: fail now, not midway
    paths = LakePaths(args.root)
    if args.job == "ingest":
        if args.kafka:
            lines = kafka_stream(spark, args.kafka, args.topic, starting_offsets=args.starting_offsets,
                                 fail_on_data_loss=not args.allow_data_loss,
                                 max_offsets_per_trigger=args.max_offsets, min_partitions=args.min_partitions)
            dlq = {"kafka": (args.kafka, args.dlq_topic)}
        else:
            lines = text_stream(spark, args.lines, max_files_per_trigger=args.max_files)
            dlq = {"dlq_path": f"{args.root.rstrip('/')}/deadletter"}
        chk = f"{paths.chk}/ingest-{args.variant}"
        if args.variant == "bronze":
            qs = start_ingest(lines, paths.bronze, chk, trigger=args.trigger or "10 seconds", **dlq)
        elif args.variant == "routed":
            qs = start_routed_ingest(lines, f"{paths.bronze}_clean", f"{paths.bronze}_flagged", chk,
                                     trigger=args.trigger or "10 seconds", one_pass=args.one_pass, **dlq)
        else:
            qs = start_card_rules_ingest(lines, f"{paths.bronze}_decided", chk,
                                         trigger=args.trigger or "1 minute", **dlq)
        if args.trigger in ("available_now", "once"):
            for q in qs:
                q.awaitTermination()
        else:
            await_any(spark)
        return {"queries": [q.id for q in qs]}
    if args.job == "refresh":
        built = hourly_refresh(spark, paths, silver_max_bytes=args.silver_max_bytes,
                               warehouse_max_bytes=args.warehouse_max_bytes)
        return {"models": sorted(built)}
    as_of = args.as_of or (dt.datetime.now(dt.timezone.utc).date() - dt.timedelta(days=1)).isoformat()
    models = {name: read_table(spark, paths.models, name)
              for name in ("mart_settlement_daily", "mart_fraud_settlement_daily")}
    return daily_reports(models, as_of, paths, files=args.files)


if __name__ == "__main__":
    main()
