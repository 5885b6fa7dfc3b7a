"""Command line of the jobs: ``spark-submit wakeline/jobs.py <job> ...`` or ``python -m wakeline.jobs <job> ...``.

Streams read a topic (``--source kafka --option subscribe=... --option kafka.bootstrap.servers=...``) or a folder of
JSON lines (``--source text --path ...``).
"""

from __future__ import annotations

import argparse
import json
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession

from wakeline import schemas
from wakeline.plans import reports
from wakeline.plans.refresh import refresh_gold, silver_table, stored
from wakeline.session import get_spark
from wakeline.sources import layers, sinks
from wakeline.sources.compaction import TARGET_BYTES, compact
from wakeline.sources.streams import read_json_stream
from wakeline.streaming import alerts, ingest

DATASETS = ("positions", "metadata")
GOLD = (
    "vessel_activity_summary", "port_traffic", "vessel_erratic_course", "vessel_dark_events",
    "vessel_speed_anomalies", "vessel_loitering", "vessel_risk_score",
)
PROFILE_COLUMNS = ["MMSI", "Latitude", "Longitude", "Sog", "ShipName", "time_utc"]


def _pairs(items: list[str]) -> dict[str, str]:
    return dict(item.split("=", 1) for item in items)


def _trigger(args: argparse.Namespace) -> dict:
    return {"availableNow": True} if args.once else {"processingTime": args.every}


def _stream(spark: SparkSession, args: argparse.Namespace, fields: schemas.Fields, **more) -> DataFrame:
    return read_json_stream(spark, args.source, fields, path=args.path, **more, **_pairs(args.option))


def _publisher(args: argparse.Namespace):
    if not args.sink:
        return None
    return lambda df: sinks.publish(df, args.sink, **_pairs(args.sink_option))


def run_stream(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "alerts":
        stream = alerts.vessel_alerts(_stream(spark, args, schemas.ALERT_INPUT), args.silence, delay=args.delay)
        query = alerts.start_alert_stream(
            stream, args.sink, args.checkpoint, trigger=_trigger(args), event_time=args.delay is not None,
            **_pairs(args.sink_option)
        )
    else:
        fields, batch = {
            "bronze-positions": (schemas.RAW_POSITION, ingest.bronze_batch),
            "bronze-metadata": (schemas.RAW_STATIC, ingest.bronze_metadata_batch),
            "silver-positions": (schemas.BRONZE_POSITIONS, ingest.silver_batch),
            "silver-metadata": (schemas.BRONZE_METADATA_INPUT, ingest.silver_metadata_batch),
        }[args.job]
        more = {"audit_path": args.audit}
        if args.job.startswith("bronze"):
            more["publish"] = _publisher(args)
        name = args.job.replace("-", "_")
        stream = _stream(spark, args, fields)
        if args.job == "silver-positions" and args.delay is not None:
            stream = ingest.once_each(stream, delay=args.delay)
        query = ingest.start(stream, batch(args.output, **more), args.checkpoint, name, _trigger(args))
    query.awaitTermination()


def run_compaction(spark: SparkSession, args: argparse.Namespace) -> None:
    day = args.date or (datetime.now(timezone.utc).date() - timedelta(days=1)).isoformat()
    for dataset in DATASETS if args.dataset == "all" else (args.dataset,):
        result = compact(
            spark, args.base, dataset, day, args.target_mb * 1024 * 1024, args.min_files, args.dry_run
        )
        print(json.dumps(result))


def run_report(spark: SparkSession, args: argparse.Namespace) -> None:
    """Every report over the stored tables."""
    silver = silver_table(spark, args.root)
    gold = {name: df for name in GOLD if (df := stored(spark, args.root, name)) is not None}
    shown = {
        "overview": reports.report_overview(silver), "top flags": reports.report_top_flags(silver),
        "regions": reports.report_regions(silver), "timeline": reports.report_timeline(silver),
        "holes": reports.report_timeline_gaps(silver), "grid": reports.report_grid(silver),
        "rows": reports.report_table_counts(gold),
    }
    if "vessel_activity_summary" in gold:
        shown["gold totals"] = reports.report_gold_totals(gold["vessel_activity_summary"])
        shown["types"] = reports.report_types(gold["vessel_activity_summary"])
    if "port_traffic" in gold:
        shown["top ports"] = reports.report_top_ports(gold["port_traffic"])
    if "vessel_risk_score" in gold:
        shown["top risk"] = reports.report_top_risk(gold["vessel_risk_score"])
        shown["risk histogram"] = reports.report_risk_histogram(gold["vessel_risk_score"])
    if "vessel_speed_anomalies" in gold:
        shown["anomaly buckets"] = reports.report_anomaly_buckets(gold["vessel_speed_anomalies"])
        shown["case file"] = reports.report_case_file(gold["vessel_speed_anomalies"], silver)
    for title, df in shown.items():
        print(title)
        df.show(20, truncate=False)


def run_profile(spark: SparkSession, args: argparse.Namespace) -> None:
    columns, partitions = schemas.LAYERS["bronze_positions"]
    layers.null_profile(layers.read_layer(spark, args.path, columns + partitions), PROFILE_COLUMNS).show(truncate=False)


def run_duplicates(spark: SparkSession, args: argparse.Namespace) -> None:
    silver = silver_table(spark, args.root)
    layers.duplicate_audit(silver).show()
    layers.duplicate_batches(silver).show(50, truncate=False)


def run_sql(spark: SparkSession, args: argparse.Namespace) -> None:
    """A query over the layers and gold tables by their names."""
    layers.register_layers(spark, args.root)
    layers.register_gold(spark, args.root, GOLD)
    spark.sql(args.query).show(args.rows, truncate=False)


def run_refresh(spark: SparkSession, args: argparse.Namespace) -> None:
    for table in DATASETS:
        problems = layers.newest_day_problems(spark, f"{args.root}/silver/{table}", sum(schemas.LAYERS[f"silver_{table}"], []))
        if problems:
            raise SystemExit(f"silver {table}: {'; '.join(problems)}")
    print(json.dumps(refresh_gold(
        spark, args.root, args.as_of, args.full_refresh, args.dedup, None if args.any_age else args.fresh_hours
    )))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="wakeline")
    jobs = top.add_subparsers(dest="job", required=True)
    for name in ("bronze-positions", "bronze-metadata", "silver-positions", "silver-metadata", "alerts"):
        job = jobs.add_parser(name)
        job.set_defaults(run=run_stream)
        job.add_argument("--source", default="kafka")
        job.add_argument("--path")
        job.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
        job.add_argument("--checkpoint", required=True)
        job.add_argument("--every", default=ingest.TRIGGER)
        job.add_argument("--once", action="store_true", help="process what is there, then stop")
        job.add_argument("--sink-option", action="append", default=[], metavar="KEY=VALUE")
        if name == "alerts":
            job.add_argument("--sink", default="kafka")
            job.add_argument("--silence", type=int, default=120, metavar="MINUTES")
            job.add_argument("--delay", help="tell silence in event time, with rows so late at most, e.g. '10 minutes'")
        else:
            job.add_argument("--output", required=True)
            job.add_argument("--audit")
            job.add_argument("--sink", help="also publish keyed JSON, e.g. kafka")
        if name == "silver-positions":
            job.add_argument("--delay", help="drop copies that come in other batches so late at most, e.g. '1 hour'")
    job = jobs.add_parser("compact")
    job.set_defaults(run=run_compaction)
    job.add_argument("--base", required=True)
    job.add_argument("--dataset", default="all", choices=("all", *DATASETS))
    job.add_argument("--date", type=lambda text: date.fromisoformat(text).isoformat())
    job.add_argument("--target-mb", type=int, default=TARGET_BYTES // (1024 * 1024))
    job.add_argument("--min-files", type=int, default=2)
    job.add_argument("--dry-run", action="store_true")
    job = jobs.add_parser("refresh")
    job.set_defaults(run=run_refresh)
    job.add_argument("--root", required=True)
    job.add_argument("--as-of")
    job.add_argument("--full-refresh", action="store_true")
    job.add_argument("--dedup", action="store_true", help="keep one row per vessel and event time")
    job.add_argument("--fresh-hours", type=float, default=2)
    job.add_argument("--any-age", action="store_true", help="run whether silver is fresh or not")
    job = jobs.add_parser("sql")
    job.set_defaults(run=run_sql)
    job.add_argument("--root", required=True)
    job.add_argument("--rows", type=int, default=50)
    job.add_argument("query")
    for name, run, place in (
        ("report", run_report, "--root"), ("duplicates", run_duplicates, "--root"), ("profile", run_profile, "--path")
    ):
        job = jobs.add_parser(name)
        job.set_defaults(run=run)
        job.add_argument(place, required=True)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(get_spark(f"wakeline-{args.job}"), args)


if __name__ == "__main__":
    main()
