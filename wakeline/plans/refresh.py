"""Refresh of all gold tables in dependency order, behind the freshness gate."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline import schemas
from wakeline.functions.timeparts import event_id
from wakeline.operators.merge import merge_into
from wakeline.operators.sequence import track_layout
from wakeline.plans import activity, dark, day_ends, erratic, loiter, ports, risk, speed
from wakeline.plans.late import JUDGED, affected_rows
from wakeline.plans.staged import write_staging
from wakeline.plans.staging import FROM_METADATA, latest_metadata, stg_vessel_positions, with_latest_metadata
from wakeline.quality.expectations import expect, failed
from wakeline.quality.suites import SUITES
from wakeline.session import use_utc, written
from wakeline.sources import snapshots
from wakeline.sources.layers import is_fresh, read_layer
from wakeline.sources.sinks import materialize
from wakeline.sources.storage import Storage

TIES = ("processing_timestamp", "_bronze_batch_id")
#: Beside the ends of days: which silver files each commit was made from.
MARKS = "_marks"
#: Beside the gold tables: which silver files the last complete refresh was made from, and the rules it went by.
DONE, SHAPE = "_refreshed.json", 2


def stored(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """A gold table, or null when it was never written."""
    path = f"{root}/gold/{name}"
    return snapshots.read(spark, path) if snapshots.exists(spark, path) else None


def silver_table(spark: SparkSession, root: str) -> DataFrame:
    columns, partitions = schemas.LAYERS["silver_positions"]
    return read_layer(spark, f"{root}/silver/positions", columns + partitions)


def metadata_table(spark: SparkSession, root: str) -> DataFrame:
    return read_layer(
        spark, f"{root}/silver/metadata", schemas.SILVER_METADATA + schemas.SILVER_BATCH + schemas.DAY_PARTITION
    )


def staging(
    spark: SparkSession, root: str, dedup: bool = False, days: Sequence[str] | None = None, meta: DataFrame | None = None
) -> DataFrame:
    """With ``days`` (texts such as ``2024-01-01``) only the rows of these days are read. ``meta`` is the static data,
    if it is at hand."""
    positions = silver_table(spark, root)
    if days is not None:
        positions = positions.where(F.col("partition_date").cast("string").isin(list(days)))
    return stg_vessel_positions(positions, metadata_table(spark, root) if meta is None else meta, dedup=dedup)


def refresh_gold(
    spark: SparkSession, root: str, as_of=None, full_refresh: bool = False, dedup: bool = False,
    fresh_hours: float | None = 2, now: datetime | None = None, test: bool = True,
) -> dict:
    """staging -> ends of days, activity, ports, dark, speed, loiter -> erratic, risk -> expectations.

    Staging is written once, by vessel, and read by the models. An incremental run looks for the days whose silver
    files changed since the last run that came to its end, however old they are: dark events and speed anomalies of
    these days are made anew, with the rows next to them; stays, last positions and the roster come from maintained
    tables of sums and ends of days. The result is that of a full refresh.

    Returns {"status": "skipped"} when no silver file is recent. Raises when an expectation of severity error fails.
    """
    use_utc(spark)
    if fresh_hours is not None and not is_fresh(spark, f"{root}/silver/positions", fresh_hours, now):
        return {"status": "skipped"}
    gold = Storage(spark, f"{root}/gold")
    seen = silver_marks(spark, root, dedup)
    days = None if full_refresh else changed_days(seen, _read_json(gold, DONE))
    meta = written(latest_metadata(metadata_table(spark, root)), "newest")
    stg = staging(spark, root, dedup, meta=meta)
    layout = track_layout(silver_table(spark, root), "mmsi", "event_timestamp")
    staged = write_staging(stg, layout)

    def table(name: str) -> DataFrame | None:
        return stored(spark, root, name)

    def replace(name: str, df: DataFrame, day: str, sort_by: list[str]) -> None:
        materialize(df, f"{root}/gold/{name}", day, sort_by)

    def events(name: str, model: Callable[..., DataFrame], key: str, sort_by: list[str]) -> None:
        """All events, or those of the changed days and of the rows after them."""
        if days is None or table(name) is None:
            replace(name, staged.each(lambda rows, how: model(rows, ties=TIES, layout=how)), "event_date", sort_by)
        elif days:
            rows = written(affected_rows(staging(spark, root, dedup, days, meta), ends, days), "affected")
            follow = rows.filter(JUDGED).filter(~F.col("date_day").cast("string").isin(days))
            gone = follow.select(event_id(F.col("mmsi"), F.col("event_timestamp")).alias(key), F.col("date_day").alias("event_date"))
            merge_into(spark, f"{root}/gold/{name}", model(rows, ties=TIES, layout=layout), key, "event_date", sort_by=sort_by,
                       whole_days=days, gone=gone)

    ends = refresh_day_ends(spark, root, full_refresh, dedup, seen, staged.rows, meta)
    replace("vessel_activity_summary", staged.each(activity.vessel_activity_summary), "date_day", ["mmsi", "flag_country"])
    replace("port_traffic", ports.port_traffic(staged.rows, ties=TIES), "date_day", ["port_name", "port_country"])
    events("vessel_dark_events", dark.vessel_dark_events, "dark_event_id", ["mmsi", "flag_country"])
    events("vessel_speed_anomalies", speed.vessel_speed_anomalies, "anomaly_id", ["mmsi", "vessel_type_normalized"])
    cells = refresh_cell_days(spark, root, full_refresh, dedup, seen, staged.rows, meta)
    replace("vessel_loitering", loiter.stays_of_days(cells), "event_date", ["mmsi", "ocean_region"])
    replace(
        "vessel_erratic_course", erratic.vessel_erratic_course(
            _or_empty(table("vessel_activity_summary"), stg, "vessel_activity_summary"), stg, TIES, ends),
        "date_day", ["mmsi"],
    )
    scores = risk.vessel_risk_score(
        stg, *[_or_empty(table(n), stg, n) for n in ("vessel_dark_events", "vessel_speed_anomalies", "vessel_loitering")],
        as_of=as_of, ties=TIES, vessels=day_ends.roster(ends, TIES),
    )
    if full_refresh:
        replace("vessel_risk_score", scores, "score_date", ["flag_country"])
    else:
        merge_into(spark, f"{root}/gold/vessel_risk_score", scores, "score_id", "score_date", True, ["flag_country"])
    staged.remove()
    gold.delete(DONE)
    gold.create(DONE, json.dumps(seen))
    report = {"status": "refreshed", "tables": [n for n in SUITES if not n.startswith("silver_")]}
    if test:
        broken = {
            name: [r["name"] for r in failed(expect(df, SUITES[name])).collect()]
            for name in report["tables"] if (df := table(name)) is not None and not df.isEmpty()
        }
        broken = {name: rules for name, rules in broken.items() if rules}
        if broken:
            raise RuntimeError(f"expectations failed: {broken}")
    return report


def silver_marks(spark: SparkSession, root: str, dedup: bool) -> dict:
    """For every day of silver a text that changes with its files. The files are listed before rows are read: what
    arrives in between is read now and once more by the next run."""
    days = snapshots.marks(Storage(spark, f"{root}/silver/positions"))
    return {"dedup": dedup, "shape": SHAPE, "days": {d.split("=")[1]: m for d, m in days.items() if not d.endswith("__")}}


def changed_days(seen: dict, known: dict | None) -> list[str] | None:
    """The days whose marks differ from those of an earlier run; null if that is not known or went by other rules."""
    if known is None or (known.get("dedup"), known.get("shape")) != (seen["dedup"], SHAPE):
        return None
    days, old = seen["days"], known["days"]
    return sorted(d for d in days.keys() | old.keys() if days.get(d) != old.get(d))


def _maintained(
    spark: SparkSession, root: str, name: str, build: Callable[[DataFrame], DataFrame], full_refresh: bool, dedup: bool,
    seen: dict | None, rows: DataFrame | None, meta: DataFrame,
) -> DataFrame:
    """A stored table with rows for each day of silver. Days whose silver files are not those of the last commit are
    made anew, whatever their date; a day without rows goes. ``rows`` has all of staging, if that is at hand.

    Static data is not stored but joined on reading, as it may come after a vessel's last position.
    """
    path = f"{root}/gold/{name}"
    storage = Storage(spark, path)
    seen = seen or silver_marks(spark, root, dedup)
    changed = None if full_refresh else changed_days(seen, _known_marks(storage))
    if changed is None or changed:
        stg = rows if changed is None and rows is not None else staging(spark, root, dedup, changed, meta)
        keep = None if changed is None else lambda day: day.split("=")[1] not in changed
        materialize(build(stg.drop(*FROM_METADATA)), path, "date_day", ["mmsi"], keep=keep)
        number = snapshots.newest(storage).number
        storage.create(f"{MARKS}/{number}.json", json.dumps(seen))
        for found in storage.files(MARKS):
            if found.name != f"{MARKS}/{number}.json":
                storage.delete(found.name)
    return snapshots.read(spark, path)


def refresh_day_ends(
    spark: SparkSession, root: str, full_refresh: bool = False, dedup: bool = False, seen: dict | None = None,
    rows: DataFrame | None = None, meta: DataFrame | None = None,
) -> DataFrame:
    """The maintained ends of days, with the newest static data of each vessel."""
    meta = metadata_table(spark, root) if meta is None else meta
    ends = _maintained(
        spark, root, "vessel_day_ends", lambda stg: day_ends.day_ends(stg, TIES), full_refresh, dedup, seen, rows, meta)
    dated = ends.withColumn("event_timestamp", F.col("last.event_timestamp"))
    told = with_latest_metadata(dated, meta)
    whole = [F.struct(f"{end}.*", *FROM_METADATA).alias(end) for end in ("first", "last")]
    return told.select("mmsi", "date_day", *whole, "port")


def refresh_cell_days(
    spark: SparkSession, root: str, full_refresh: bool = False, dedup: bool = False, seen: dict | None = None,
    rows: DataFrame | None = None, meta: DataFrame | None = None,
) -> DataFrame:
    """The maintained sums of slow rows by vessel, cell and day, with the newest static data of each vessel."""
    meta = metadata_table(spark, root) if meta is None else meta
    cells = _maintained(spark, root, "vessel_cell_days", loiter.cell_days, full_refresh, dedup, seen, rows, meta)
    dated = cells.withColumn("event_timestamp", F.col("end"))
    return with_latest_metadata(dated, meta).select(*cells.columns, "vessel_type_normalized")


def _known_marks(storage: Storage) -> dict | None:
    """What the newest commit was made from; null if the writer stopped before it could say so."""
    return _read_json(storage, f"{MARKS}/{snapshots.newest(storage).number}.json")


def _read_json(storage: Storage, name: str) -> dict | None:
    try:
        return json.loads(storage.text(name)) if storage.exists(name) else None
    except ValueError:
        return None


def _or_empty(df: DataFrame | None, stg: DataFrame, name: str) -> DataFrame:
    """The stored table, or the model's own schema without rows when nothing was ever found."""
    if df is not None:
        return df
    model = {
        "vessel_activity_summary": activity.vessel_activity_summary,
        "vessel_dark_events": dark.vessel_dark_events, "vessel_speed_anomalies": speed.vessel_speed_anomalies,
        "vessel_loitering": loiter.vessel_loitering,
    }[name]
    return model(stg).limit(0)
