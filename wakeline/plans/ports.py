"""Daily traffic per port."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeline import refdata as ref
from wakeline.operators.sequence import TrackLayout, with_previous

PORT_DAY = ["port_name", "port_country", "date_day"]


def port_entries(
    stg: DataFrame, entry_mode: str = "first", ties: tuple[str, ...] = (), layout: TrackLayout | None = None
) -> DataFrame:
    """(port_name, port_country, date_day, mmsi): the port-days a vessel entered.

    ``first``: a vessel's earliest in-port row counts as its one entry. ``transition``: every change from
    outside all boxes, or from another port, into a port counts.
    """
    if entry_mode == "first":
        moment = F.struct("event_timestamp", *ties)
        per_day = (
            stg.filter(F.col("port_name").isNotNull())
            .groupBy(*PORT_DAY, "mmsi")
            .agg(F.min(moment).alias("_moment"))
        )
        # at most ports x days rows per vessel reach this window
        vessel = Window.partitionBy("mmsi")
        return (
            per_day.withColumn("_first", F.min("_moment").over(vessel))
            .filter(F.col("_moment") == F.col("_first"))
            .select(*PORT_DAY, "mmsi")
        )
    if entry_mode == "transition":
        before = with_previous(stg, {"_was_in": "port_name"}, ties=ties, layout=layout)
        return (
            before.filter(F.col("port_name").isNotNull() & ~F.col("port_name").eqNullSafe(F.col("_was_in")))
            .select(*PORT_DAY, "mmsi")
            .distinct()
        )
    raise ValueError("entry_mode must be 'first' or 'transition'")


def port_traffic(
    stg: DataFrame, entry_mode: str = "first", ties: tuple[str, ...] = (), layout: TrackLayout | None = None
) -> DataFrame:
    """One row per (port, country, day).

    Rows are first combined per vessel, so the twelve distinct counts become plain sums over one row per vessel.
    A vessel has one ship category (its newest static data) and one flag (its MMSI), which makes this exact.
    """
    in_port = stg.filter(F.col("port_name").isNotNull())
    category = F.coalesce("vessel_type_normalized", F.lit(ref.SHIP_TYPE_MISSING))
    speed, change = F.col("speed_over_ground"), F.col("speed_change_rate")
    per_vessel = in_port.groupBy(*PORT_DAY, "mmsi").agg(
        F.max(category).alias("_category"),
        F.max("flag_country").alias("_flag"),
        F.count(F.lit(1)).alias("_rows"),
        F.sum(speed).alias("_speed_sum"),
        F.count(speed).alias("_speed_rows"),
        F.max(speed).alias("_speed_max"),
        F.count_if(change > 3).alias("_manoeuvres"),
        F.sum(change).alias("_change_sum"),
        F.count(change).alias("_change_rows"),
        F.min("event_timestamp").alias("_from"),
        F.max("event_timestamp").alias("_to"),
        F.min(F.struct("event_timestamp", *ties)).alias("_moment"),
    )
    if entry_mode == "first":
        earliest = F.min("_moment").over(Window.partitionBy("mmsi"))
        flagged = per_vessel.withColumn("_entered", F.col("_moment") == earliest)
    else:
        entries = port_entries(stg, entry_mode, ties, layout).withColumn("_entry", F.lit(True))
        flagged = per_vessel.join(entries, [*PORT_DAY, "mmsi"], "left").withColumn(
            "_entered", F.col("_entry").isNotNull()
        )
    named = [
        F.count_if(F.col("_category") == name).alias(f"{name}_vessels") for name in ref.NAMED_PORT_CATEGORIES
    ]
    return flagged.groupBy(*PORT_DAY).agg(
        F.count(F.lit(1)).alias("unique_vessels"),
        F.sum("_rows").alias("total_position_reports"),
        *named,
        F.count_if(~F.col("_category").isin(ref.NAMED_PORT_CATEGORIES)).alias("other_vessels"),
        F.count_distinct("_flag").alias("distinct_flag_countries"),
        F.round(F.sum("_speed_sum") / F.sum("_speed_rows"), 2).alias("avg_speed_in_port"),
        F.round(F.max("_speed_max"), 2).alias("max_speed_in_port"),
        F.sum("_manoeuvres").alias("sudden_manoeuvres"),
        F.round(F.sum("_change_sum") / F.sum("_change_rows"), 3).alias("avg_speed_change_rate"),
        F.count_if("_entered").alias("vessel_entries"),
        F.min("_from").alias("first_activity"),
        F.max("_to").alias("last_activity"),
        F.current_timestamp().alias("gold_processed_at"),
    )
