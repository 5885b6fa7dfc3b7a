"""The registered queries: each reads whole driver tables and returns one DataFrame.

Times and dates leave as text and clock stamps are left out, so results compare across engines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.functions import clean, lookup
from wakeline.functions.timeparts import normalize_time, stamp
from wakeline.operators.boxes import in_first_box
from wakeline.operators.dedup import dedup_latest
from wakeline.operators.incremental import incremental_cutoff
from wakeline.operators.merge import merge_into, merge_upsert
from wakeline.operators.sequence import TrackLayout, track_layout
from wakeline.plans import activity, alerts, bronze, dark, day_ends, erratic, loiter, ports, reports, risk, silver, speed, staging
from wakeline.plans.staged import Staged, write_staging
from wakeline.quality.expectations import expect
from wakeline.quality.suites import SUITES
from wakeline.schemas import AUDIT, BRONZE_POSITIONS, RAW_POSITION, RAW_STATIC, ddl
from wakeline.session import shared_dir, use_utc, written
from wakeline.sources import events_adapter as adapter
from wakeline.sources import layers, routing, snapshots
from wakeline.sources.compaction import compact
from wakeline.sources.sinks import materialize, publish, write_idempotent
from wakeline.sources.streams import parse_json, read_json_stream
from wakeline.streaming import alerts as live
from wakeline.streaming import ingest

CLOCK_COLUMNS = ("gold_processed_at", "processing_timestamp", "ingestion_timestamp", "_ingestion_date")


def comparable(df: DataFrame, thousandths: tuple[str, ...] = (), doubles: tuple[str, ...] = ()) -> DataFrame:
    """Text for times and dates, no clock stamps; float results of trigonometry and long sums at 3 decimals."""
    kinds = dict(df.dtypes)
    columns = []
    for name in df.columns:
        if name in CLOCK_COLUMNS:
            continue
        column = F.col(f"`{name}`")
        if kinds[name] in ("timestamp", "timestamp_ntz"):
            column = stamp(column)
        elif kinds[name] == "date":
            column = column.cast("string")
        elif name in thousandths:
            column = F.round(column, 3)
        elif name in doubles or kinds[name] == "float":
            column = column.cast("double")
        columns.append(column.alias(name))
    return df.select(*columns)


class Frames:
    """Lazy layer frames over one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = use_utc(spark), sf_dir

    def table(self, name: str) -> DataFrame:
        return adapter.table(self.spark, self.sf_dir, name)

    def event_stream(self) -> DataFrame:
        """The events file as a stream source."""
        schema = self.table("events").schema
        return self.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(self.sf_dir)

    def scratch(self, name: str) -> str:
        """A new folder in the shared directory for one run of a stream."""
        return f"{shared_dir(self.spark)}/{name}-{uuid.uuid4().hex}"

    @cached_property
    def raw(self) -> DataFrame:
        return adapter.raw_messages(self.table("events"))

    @cached_property
    def bronze(self) -> DataFrame:
        return adapter.bronze_from_events(self.table("events"))

    @cached_property
    def layout(self) -> TrackLayout:
        return track_layout(self.bronze, "MMSI", "time_utc")

    @cached_property
    def replayed(self) -> DataFrame:
        return adapter.with_replayed_rows(self.bronze)

    @cached_property
    def silver(self) -> DataFrame:
        return silver.silver_positions(self.bronze, tie_break=("_row_id",), layout=self.layout)

    @cached_property
    def replayed_silver(self) -> DataFrame:
        """What silver holds after a batch was processed twice: renamed rows of both copies."""
        return silver.rename_positions(self.replayed)

    @cached_property
    def metadata(self) -> DataFrame:
        raw = adapter.metadata_from_orders(self.table("orders"))
        return silver.silver_metadata(raw, processed_at=F.col("ingestion_timestamp"), keep=("_row_id",))

    @cached_property
    def stg(self) -> DataFrame:
        return staging.stg_vessel_positions(self.silver, self.metadata, meta_tie_break=("_row_id",), layout=self.layout)

    @cached_property
    def staged(self) -> Staged:
        """Staging written once, by vessel."""
        return write_staging(self.stg, self.layout)

    @cached_property
    def ends(self) -> DataFrame:
        return day_ends.day_ends(self.stg)

    @cached_property
    def activity(self) -> DataFrame:
        return activity.vessel_activity_summary(self.stg, layout=self.layout)

    @cached_property
    def ports(self) -> DataFrame:
        return ports.port_traffic(self.stg)

    @cached_property
    def erratic(self) -> DataFrame:
        return erratic.vessel_erratic_course(self.activity, self.stg)

    @cached_property
    def dark(self) -> DataFrame:
        return dark.vessel_dark_events(self.stg, layout=self.layout)

    @cached_property
    def speed(self) -> DataFrame:
        return speed.vessel_speed_anomalies(self.stg, layout=self.layout)

    @cached_property
    def loiter(self) -> DataFrame:
        return loiter.vessel_loitering(self.stg)

    @cached_property
    def risk(self) -> DataFrame:
        dark_events, anomalies, stays = (self.staged.each(model) for model in (
            lambda stg, layout: dark.vessel_dark_events(stg, layout=layout),
            lambda stg, layout: speed.vessel_speed_anomalies(stg, layout=layout),
            lambda stg, layout: loiter.vessel_loitering(stg)))
        return risk.vessel_risk_score(self.staged.rows, dark_events, anomalies, stays, as_of=adapter.AS_OF)

    @cached_property
    def alerts(self) -> DataFrame:
        return alerts.vessel_alerts_batch(self.bronze, layout=self.layout)


def silver_positions(f: Frames) -> DataFrame:
    return comparable(f.silver, thousandths=("distance_to_port_km",), doubles=("heading",))


def vessel_speed_anomalies(f: Frames) -> DataFrame:
    return comparable(f.speed, thousandths=("calculated_speed_knots", "speed_excess_knots"))


QUERIES: dict[str, Callable[[Frames], DataFrame]] = {
    "silver_positions": silver_positions,
    "silver_metadata": lambda f: comparable(f.metadata.withColumn("processed_at", F.col("processing_timestamp"))),
    "stg_vessel_positions": lambda f: comparable(f.stg, thousandths=("distance_to_port_km",), doubles=("heading",)),
    "vessel_activity_summary": lambda f: comparable(f.activity, doubles=("max_ais_gap_minutes",)),
    "port_traffic": lambda f: comparable(f.ports),
    "port_traffic_transition": lambda f: comparable(
        ports.port_traffic(f.stg, entry_mode="transition", layout=f.layout)
    ),
    "port_entries": lambda f: comparable(ports.port_entries(f.stg)),
    "vessel_erratic_course": lambda f: comparable(f.erratic),
    "vessel_dark_events": lambda f: comparable(f.dark, thousandths=("displacement_km",)),
    "vessel_speed_anomalies": vessel_speed_anomalies,
    "vessel_loitering": lambda f: comparable(f.loiter, thousandths=("avg_speed_knots", "avg_heading_change")),
    "vessel_risk_score": lambda f: comparable(f.risk),
    "vessel_roster": lambda f: comparable(risk.vessel_roster(f.stg)),
    "vessel_alerts_batch": lambda f: comparable(f.alerts),
    "silent_vessels": lambda f: comparable(alerts.silent_vessels(f.bronze, adapter.AS_OF)),
    "dedup_latest": lambda f: comparable(
        dedup_latest(f.replayed_silver, latest_by=("ingestion_timestamp", "_row_id")).select(
            "mmsi", "event_timestamp", "vessel_name", "_bronze_batch_id", "_row_id"
        )
    ),
    "latest_metadata": lambda f: comparable(
        staging.latest_metadata(f.metadata, ("_row_id",)).withColumn("processed_at", F.col("processing_timestamp"))
    ),
}


# Bronze -------------------------------------------------------------------------------------------------------------


def bronze_flatten(f: Frames) -> DataFrame:
    """Raw JSON text -> flat columns; unreadable texts and other message types drop out."""
    return comparable(
        bronze.flatten_positions(parse_json(f.raw, RAW_POSITION)),
        doubles=("UserID", "TrueHeading", "NavigationalStatus"),
    )


def bronze_validate(f: Frames) -> DataFrame:
    """Accepted rows with event time, day and hour."""
    positions, _, _ = routing.route_messages(f.raw)
    rows = bronze.bronze_positions(positions, "b")
    return comparable(rows.select("MMSI", "Latitude", "Longitude", "Sog", "time_utc", "partition_date", "partition_hour"))


def bronze_rejected(f: Frames) -> DataFrame:
    rows = bronze.rejected_positions(bronze.flatten_positions(parse_json(f.raw, RAW_POSITION)))
    return comparable(rows.select("MMSI", "Latitude", "Longitude", "ShipName", "time_utc"))


def bronze_metadata(f: Frames) -> DataFrame:
    rows = bronze.bronze_metadata(parse_json(f.raw, RAW_STATIC), "b")
    return comparable(rows.drop("partition_date"))


def route_messages(f: Frames) -> DataFrame:
    routed = routing.classify_messages(f.raw)
    return routed.select("event_id", "route", "reject_reason", F.col("MetaData.time_utc").alias("time_utc"))


def normalized_time(f: Frames) -> DataFrame:
    text = F.get_json_object("value", "$.MetaData.time_utc")
    return comparable(f.raw.select("event_id", normalize_time(text).alias("time_utc")))


# Building blocks ----------------------------------------------------------------------------------------------------


def stg_dedup(f: Frames) -> DataFrame:
    """Staging over silver that holds replayed rows: the newest copy wins."""
    twice = silver.select_silver(
        silver.with_port_zone(silver.with_ocean_region(f.replayed_silver)).withColumns({
            "speed_change_rate": F.lit(None).cast("double"), "heading_change_degrees": F.lit(None).cast("double"),
            "processing_timestamp": F.col("ingestion_timestamp"),
        })
    )
    rows = staging.stg_vessel_positions(twice, f.metadata, dedup=True, meta_tie_break=("_row_id",))
    return comparable(rows.select("mmsi", "event_timestamp", "vessel_name", "_bronze_batch_id", "vessel_type_normalized"))


def speed_limits(f: Frames) -> DataFrame:
    limit = lookup.speed_limit(F.col("vessel_type_normalized")).alias("type_max_speed")
    return f.stg.select("vessel_type_normalized", limit).groupBy("vessel_type_normalized", "type_max_speed").agg(
        F.count(F.lit(1)).alias("n")
    )


def first_half(f: Frames, model: DataFrame, moment: str) -> DataFrame:
    """A gold table as it was stored on the second day at noon."""
    return model.filter(F.col(moment) < F.lit("2024-01-02 12:00:00").cast("timestamp"))


def dark_incremental(f: Frames, compat: bool) -> DataFrame:
    target = first_half(f, f.dark, "signal_recovered_at")
    events = dark.vessel_dark_events(f.stg, target=target, compat=compat, layout=f.layout)
    return comparable(events, thousandths=("displacement_km",))


def dark_seeded(f: Frames) -> DataFrame:
    """The stored half plus an incremental run whose seeds come from the ends of days: the same as a full run.

    Staging and the stored half are written once, as every step of the run reads them."""
    stg = f.staged.rows
    full = f.staged.each(lambda rows, layout: dark.vessel_dark_events(rows, layout=layout))
    target = written(first_half(f, full, "signal_recovered_at"), "dark")
    cutoff = incremental_cutoff(target, "signal_recovered_at", dark.LOOKBACK_HOURS)
    seeds = day_ends.seeds_before(day_ends.day_ends(stg), stg, cutoff)
    new = dark.vessel_dark_events(stg, target, layout=f.layout, seeds=seeds)
    return comparable(merge_upsert(target, new, "dark_event_id"), thousandths=("displacement_km",))


def speed_incremental(f: Frames) -> DataFrame:
    target = first_half(f, f.speed, "event_timestamp")
    events = speed.vessel_speed_anomalies(f.stg, target=target, layout=f.layout)
    return comparable(events, thousandths=("calculated_speed_knots", "speed_excess_knots"))


def loiter_incremental(f: Frames) -> DataFrame:
    target = first_half(f, f.loiter, "window_start")
    stays = loiter.vessel_loitering(f.stg, target=target)
    return comparable(stays, thousandths=("avg_speed_knots", "avg_heading_change"))


def _merge_sides(f: Frames) -> tuple[DataFrame, DataFrame]:
    events = f.dark.select("dark_event_id", "mmsi", "gap_minutes", "severity", "event_date")
    target = events.filter(F.col("event_date") <= F.lit("2024-01-02").cast("date"))
    updates = events.filter(F.col("event_date") >= F.lit("2024-01-02").cast("date"))
    return target, updates.withColumn("severity", F.lower("severity"))


def merge_upsert_query(f: Frames) -> DataFrame:
    target, updates = _merge_sides(f)
    return comparable(merge_upsert(target, updates, "dark_event_id"))


def merge_sync_schema(f: Frames) -> DataFrame:
    """The updates bring a new column and drop one."""
    target, updates = _merge_sides(f)
    changed = updates.drop("gap_minutes").withColumn("reviewed", F.lit(True))
    return comparable(merge_upsert(target, changed, "dark_event_id", sync_schema=True))


def risk_signals(f: Frames) -> DataFrame:
    """The three 30-day aggregates side by side, for vessels that have any of them."""
    parts = [
        risk.dark_30d(f.dark, adapter.AS_OF),
        risk.speed_30d(f.speed, adapter.AS_OF),
        risk.loiter_30d(f.loiter, adapter.AS_OF),
    ]
    both = parts[0].join(parts[1], "mmsi", "full").join(parts[2], "mmsi", "full")
    counts = [c for c in both.columns if c not in ("mmsi", "total_excess_knots")]
    return comparable(both.na.fill(0, counts).na.fill(0.0, ["total_excess_knots"]), thousandths=("total_excess_knots",))


def expectations(name: str) -> Callable[[Frames], DataFrame]:
    attribute = {
        "silver_positions": "silver", "silver_metadata": "metadata", "vessel_activity_summary": "activity",
        "port_traffic": "ports", "vessel_erratic_course": "erratic", "vessel_dark_events": "dark",
        "vessel_speed_anomalies": "speed", "vessel_loitering": "loiter", "vessel_risk_score": "risk",
    }[name]
    return lambda f: expect(getattr(f, attribute), SUITES[name])


# Streams ------------------------------------------------------------------------------------------------------------


def vessel_alerts_stream(f: Frames) -> DataFrame:
    """The stateful alert stream over the events file, drained into a Parquet folder and read back."""
    positions = adapter.bronze_from_events(f.event_stream()).select(
        "MMSI", "Latitude", "Longitude", "Sog", stamp(F.col("time_utc")).alias("time_utc")
    )
    out = f.scratch("alerts")
    live.start_alert_stream(
        live.vessel_alerts(positions), "parquet", f"{out}/checkpoint", trigger={"availableNow": True},
        name=None, keyed_json=False, path=f"{out}/rows",
    ).awaitTermination()
    return f.spark.read.parquet(f"{out}/rows").drop("detected_at")


def silver_stream(f: Frames) -> DataFrame:
    """Silver through micro-batches with one folder per batch, read back as a table."""
    out = f.scratch("silver")
    ingest.start(
        adapter.bronze_from_events(f.event_stream()), ingest.silver_batch(f"{out}/rows"), f"{out}/checkpoint",
        name=None, trigger={"availableNow": True},
    ).awaitTermination()
    rows = f.spark.read.parquet(f"{out}/rows").drop("batch", "partition_date", "_silver_batch_id")
    return comparable(rows, thousandths=("distance_to_port_km",), doubles=("heading",))


def table_counts(f: Frames) -> DataFrame:
    """All models over staging written once, by vessel."""
    each, rows = f.staged.each, f.staged.rows

    def erratic_days(stg: DataFrame, layout: TrackLayout) -> DataFrame:
        return erratic.vessel_erratic_course(activity.vessel_activity_summary(stg, layout=layout), stg)

    return reports.report_table_counts({
        "vessel_activity_summary": each(lambda stg, layout: activity.vessel_activity_summary(stg, layout=layout)),
        "port_traffic": ports.port_traffic(rows), "vessel_erratic_course": each(erratic_days),
        "vessel_dark_events": each(lambda stg, layout: dark.vessel_dark_events(stg, layout=layout)),
        "vessel_speed_anomalies": each(lambda stg, layout: speed.vessel_speed_anomalies(stg, layout=layout)),
        "vessel_loitering": each(lambda stg, layout: loiter.vessel_loitering(stg)), "vessel_risk_score": f.risk,
    })


QUERIES |= {
    "bronze_flatten": bronze_flatten,
    "bronze_validate": bronze_validate,
    "bronze_rejected": bronze_rejected,
    "bronze_metadata": bronze_metadata,
    "route_messages": route_messages,
    "normalize_time": normalized_time,
    "stg_dedup": stg_dedup,
    "ocean_region_lookup": lambda f: silver.with_ocean_region(silver.rename_positions(f.bronze)).groupBy(
        "ocean_region"
    ).agg(F.count(F.lit(1)).alias("n"), F.min("latitude").alias("south"), F.max("latitude").alias("north")),
    "port_zone_lookup": lambda f: silver.with_port_zone(silver.rename_positions(f.bronze)).groupBy(
        "port_name", "port_country", "is_in_port_zone"
    ).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("mmsi").alias("vessels")),
    "port_distance": lambda f: silver.with_port_zone(silver.rename_positions(f.bronze)).filter("is_in_port_zone").select(
        "mmsi", "port_name", F.col("_row_id").alias("event_id"), F.round("distance_to_port_km", 3).alias("distance_to_port_km")
    ),
    "flag_lookup": lambda f: f.bronze.select("MMSI", lookup.flag_of(F.col("MMSI")).alias("flag_country")).groupBy(
        "flag_country"
    ).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("MMSI").alias("vessels")),
    "nav_status_lookup": lambda f: f.bronze.groupBy(
        F.col("NavigationalStatus").cast("bigint").alias("code"),
        lookup.nav_label(F.col("NavigationalStatus")).alias("navigational_status"),
    ).agg(F.count(F.lit(1)).alias("n")),
    "ship_type_lookup": lambda f: adapter.metadata_from_orders(f.table("orders")).groupBy(
        F.col("Type").cast("bigint").alias("code"), lookup.ship_category(F.col("Type")).alias("category")
    ).agg(F.count(F.lit(1)).alias("n")),
    "speed_limit_lookup": speed_limits,
    "masked_vessels": lambda f: f.bronze.groupBy(clean.mask_mmsi(F.col("MMSI")).alias("mmsi")).agg(
        F.count(F.lit(1)).alias("n")
    ),
    "movement_deltas": lambda f: comparable(
        f.silver.select("mmsi", "event_timestamp", "speed_change_rate", "heading_change_degrees")
    ),
    "day_segments": lambda f: comparable(
        activity.day_segments(f.stg, f.layout).select("mmsi", "event_timestamp", "minutes_since_prev", "segment_distance_km"),
        thousandths=("segment_distance_km",), doubles=("minutes_since_prev",),
    ),
    "loiter_candidates": lambda f: comparable(
        loiter.loiter_candidates(f.stg).select("mmsi", "event_timestamp", "speed_over_ground", "lat_cell", "lon_cell")
    ),
    "incremental_cutoff": lambda f: dark_incremental(f, compat=True),
    "dark_events_incremental": lambda f: dark_incremental(f, compat=False),
    "speed_anomalies_incremental": speed_incremental,
    "loitering_incremental": loiter_incremental,
    "merge_upsert": merge_upsert_query,
    "merge_sync_schema": merge_sync_schema,
    "risk_signals_30d": risk_signals,
    "null_profile": lambda f: layers.null_profile(
        f.bronze, ["MMSI", "Latitude", "Longitude", "Sog", "RateOfTurn", "_source_file", "time_utc"]
    ),
    "duplicate_audit": lambda f: layers.duplicate_audit(f.replayed_silver),
    "duplicate_batches": lambda f: comparable(
        layers.duplicate_batches(f.replayed_silver, processed="ingestion_timestamp")
    ),
    "report_overview": lambda f: comparable(reports.report_overview(f.silver)),
    "report_gold_totals": lambda f: reports.report_gold_totals(f.activity),
    "report_table_counts": table_counts,
    "report_top_flags": lambda f: reports.report_top_flags(f.silver),
    "report_regions": lambda f: reports.report_regions(f.silver),
    "report_types": lambda f: reports.report_types(f.activity),
    "report_timeline": lambda f: reports.report_timeline(f.silver),
    "report_timeline_gaps": lambda f: reports.report_timeline_gaps(f.silver),
    "report_timeline_gaps_minute": lambda f: reports.report_timeline_gaps(f.silver, seconds=60),
    "report_grid": lambda f: reports.report_grid(f.silver),
    "report_top_ports": lambda f: reports.report_top_ports(f.ports),
    "report_top_risk": lambda f: reports.report_top_risk(f.risk),
    "report_risk_histogram": lambda f: reports.report_risk_histogram(f.risk),
    "report_anomaly_buckets": lambda f: comparable(reports.report_anomaly_buckets(f.speed), thousandths=("lo",)),
    "report_case_file": lambda f: comparable(reports.report_case_file(f.speed, f.silver)),
    "alerts_by_type": lambda f: reports.alerts_by_type(f.alerts),
    "latest_alerts": lambda f: reports.latest_alerts(f.alerts),
    "vessel_alerts_stream": vessel_alerts_stream,
    "silver_stream": silver_stream,
    **{f"expectations_{name}": expectations(name) for name in SUITES},
}


# The ways for data that outgrows one window or one broadcast, forced on the given tables.


def sliced(f: Frames) -> TrackLayout:
    return track_layout(f.bronze, "MMSI", "time_utc", rows_per_window=10, ranges=64)


def movement_deltas_sliced(f: Frames) -> DataFrame:
    rows = silver.silver_positions(f.bronze, tie_break=("_row_id",), layout=sliced(f))
    return comparable(rows.select("mmsi", "event_timestamp", "speed_change_rate", "heading_change_degrees"))


def stg_salted(f: Frames) -> DataFrame:
    """Staging with the salted join that replaces the broadcast for a large lookup."""
    rows = staging.stg_vessel_positions(f.silver, f.metadata, meta_tie_break=("_row_id",), broadcast_rows=1)
    return comparable(rows, thousandths=("distance_to_port_km",), doubles=("heading",))


QUERIES |= {
    "movement_deltas_sliced": movement_deltas_sliced,
    "stg_salted": stg_salted,
    "dark_events_sliced": lambda f: comparable(
        dark.vessel_dark_events(f.stg, layout=sliced(f)), thousandths=("displacement_km",)
    ),
    "activity_sliced": lambda f: comparable(
        activity.vessel_activity_summary(f.stg, layout=sliced(f)), doubles=("max_ais_gap_minutes",)
    ),
    "dead_letters": lambda f: routing.route_messages(f.raw)[2].groupBy("error", "source").agg(
        F.count(F.lit(1)).alias("n")
    ),
}


# Tables written, changed and read back.


def by_day(f: Frames) -> DataFrame:
    return f.table("events").select("event_id", "event_type", "value", F.to_date("ts").alias("day"))


def merge_into_table(f: Frames) -> DataFrame:
    """The first half of the month, then a merge of all purchases with twice their value, over new and old days."""
    path = f.scratch("merge")
    rows = by_day(f)
    materialize(rows.where("day < date'2024-01-16'"), path, "day", ["event_id"])
    merge_into(f.spark, path, rows.where("event_type = 'purchase'").withColumn("value", F.col("value") * 2), "event_id", "day")
    return comparable(snapshots.read(f.spark, path))


def compact_table(f: Frames) -> DataFrame:
    """Micro-batches of every event type, one of them replayed, then one day compacted; rows and files left by day."""
    path = f.scratch("compact")
    rows = by_day(f).withColumnRenamed("day", "partition_date")
    for epoch, kind in enumerate(("view", "click", "purchase", "click")):
        batch = rows.where(F.col("event_type") == kind) if kind != "view" else rows.where("event_type NOT IN ('click', 'purchase')")
        write_idempotent(batch, f"{path}/events", 1 if epoch == 3 else epoch, ["partition_date"])
    compact(f.spark, path, "events", "2024-01-02")
    table = snapshots.read(f.spark, f"{path}/events")
    return comparable(table.select("event_id", "event_type", "value", F.col("partition_date").alias("day")))


QUERIES |= {
    "merge_into_table": merge_into_table,
    "compact_table": compact_table,
    "dark_events_seeded": dark_seeded,
    "erratic_by_day_ends": lambda f: comparable(erratic.vessel_erratic_course(f.activity, f.stg, ends=f.ends)),
}


# Chained streams ----------------------------------------------------------------------------------------------------


def bronze_stream(f: Frames) -> str:
    """The raw feed as a folder of JSON lines, streamed into the bronze archive and the keyed topic, with its audit."""
    out = f.scratch("bronze")
    # The feed's times carry nanoseconds and a zone name; what reads the feed passes them on in the ISO form.
    f.raw.select(F.regexp_replace("value", r"123 \+0000 UTC", "+00:00").alias("value")).write.text(f"{out}/raw")
    ingest.start(
        read_json_stream(f.spark, "text", RAW_POSITION, path=f"{out}/raw"),
        ingest.bronze_batch(f"{out}/rows", lambda rows: publish(rows, "json", path=f"{out}/topic"), f"{out}/audit"),
        f"{out}/checkpoint", name=None, trigger={"availableNow": True},
    ).awaitTermination()
    return out


def keyed_json(f: Frames) -> DataFrame:
    """Raw JSON -> bronze stream -> keyed JSON -> silver stream, read back: two streams in a row."""
    out = bronze_stream(f)
    ingest.start(
        read_json_stream(f.spark, "json", BRONZE_POSITIONS, path=f"{out}/topic", truncate_ms=True),
        ingest.silver_batch(f"{out}/silver"), f"{out}/checkpoint-silver", name=None, trigger={"availableNow": True},
    ).awaitTermination()
    rows = f.spark.read.parquet(f"{out}/silver")
    return comparable(rows.select(
        "mmsi", "vessel_name", "flag_country", "latitude", "longitude", "ocean_region", "port_name", "speed_over_ground",
        "navigational_status", "event_timestamp", "_source_system",
    ))


def bronze_audit(f: Frames) -> DataFrame:
    return f.spark.read.schema(ddl(AUDIT)).parquet(f"{bronze_stream(f)}/audit")


def batch_audit(f: Frames) -> DataFrame:
    """What the batches of the bronze stream read, wrote and rejected, by reason, summed over its batches."""
    counts = [name for name, _ in AUDIT if name.startswith(("rows_", "invalid_", "missing_"))]
    return bronze_audit(f).groupBy("layer").agg(*[F.sum(c).alias(c) for c in counts])


def layer_gap(f: Frames) -> DataFrame:
    """The share of read positions that the batches of the last quarter of an hour did not write."""
    return reports.layer_gap(bronze_audit(f), minutes=15).withColumn("gap", F.round("gap", 6))


def silence_stream(f: Frames) -> DataFrame:
    """The alert stream with silence told in event time: the same in one batch or many, also when drained."""
    positions = adapter.bronze_from_events(f.event_stream()).select(
        "MMSI", "Latitude", "Longitude", "Sog", stamp(F.col("time_utc")).alias("time_utc")
    )
    out = f.scratch("silence")
    live.start_alert_stream(
        live.vessel_alerts(positions, delay="10 minutes"), "parquet", f"{out}/checkpoint", trigger={"availableNow": True},
        name=None, keyed_json=False, event_time=True, path=f"{out}/rows",
    ).awaitTermination()
    return f.spark.read.parquet(f"{out}/rows").drop("detected_at")


def stream_once_each(f: Frames) -> DataFrame:
    """All positions twice, in different micro-batches: one copy of each comes through."""
    out = f.scratch("once")
    rows = f.bronze.select("MMSI", "time_utc", "Latitude", "Longitude")
    for _ in range(2):
        rows.write.mode("append").parquet(f"{out}/in")
    stream = f.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{out}/in")
    # The copies come when the watermark has passed the month: only a longer delay leaves them to the state.
    ingest.once_each(stream, delay="60 days").writeStream.trigger(availableNow=True).option(
        "checkpointLocation", f"{out}/checkpoint").start(path=f"{out}/rows", format="parquet").awaitTermination()
    found = f.spark.read.schema(rows.schema).parquet(f"{out}/rows")
    return comparable(found.groupBy("MMSI", "time_utc").agg(F.count(F.lit(1)).alias("copies")))


# Boxes, visits and holes --------------------------------------------------------------------------------------------


def box_index_lookup(f: Frames) -> DataFrame:
    """Every position in the first of as many boxes as there are customers."""
    points = f.bronze.select(F.col("_row_id").alias("event_id"), F.col("Latitude").alias("latitude"), F.col("Longitude").alias("longitude"))
    boxes = adapter.boxes_from_customers(f.table("customer"))
    return in_first_box(points, boxes, ["zone_id", "zone"]).select("event_id", "zone_id", "zone")


def loitering_sessions(f: Frames, layout: TrackLayout) -> DataFrame:
    """Every visit to a cell is a stay of its own, and half an hour is long enough."""
    rows = loiter.vessel_loitering(f.stg, sessionize=12 * 60, layout=layout)
    return comparable(rows, thousandths=("avg_speed_knots", "avg_heading_change"))


def timeline_hole(f: Frames) -> DataFrame:
    """The day's five-minute labels without those from 09:00 to 10:59."""
    return reports.report_timeline_gaps(f.silver.filter(~F.hour("event_timestamp").isin(9, 10)))


QUERIES |= {
    "keyed_json": keyed_json,
    "batch_audit": batch_audit,
    "layer_gap": layer_gap,
    "silence_stream": silence_stream,
    "stream_once_each": stream_once_each,
    "box_index_lookup": box_index_lookup,
    "loitering_sessions": lambda f: loitering_sessions(f, f.layout),
    "loitering_sessions_sliced": lambda f: loitering_sessions(f, sliced(f)),
    "report_timeline_hole": timeline_hole,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Callable[[Frames], DataFrame]):
        return lambda spark, sf_dir: build(Frames(spark, sf_dir))

    return {name: bind(build) for name, build in QUERIES.items()}
