"""Daily activity per vessel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.functions.geo import flat_km
from wakeline.functions.timeparts import elapsed
from wakeline.operators.sequence import TrackLayout, with_previous

#: What the summary reads of staging.
READ = (
    "mmsi", "date_day", "event_timestamp", "latitude", "longitude", "vessel_name", "flag_country", "vessel_type_normalized",
    "ocean_region", "port_name", "is_in_port_zone", "speed_over_ground", "speed_change_rate", "heading_change_degrees",
    "destination_clean", "_source_system", "_pipeline_version",
)


def avg_if(condition: Column, value: Column) -> Column:
    return F.avg(F.when(condition, value))


def day_segments(stg: DataFrame, layout: TrackLayout | None = None) -> DataFrame:
    """Minutes and flat distance since the vessel's previous row of the same day (first row: null and 0)."""
    before = with_previous(
        stg, {"_before": "event_timestamp", "_lat": "latitude", "_lon": "longitude"}, per_day="date_day", layout=layout
    )
    step = flat_km(F.col("latitude") - F.col("_lat"), F.col("longitude") - F.col("_lon"))
    return before.withColumns({
        "minutes_since_prev": elapsed("MINUTE", F.col("event_timestamp"), F.col("_before")),
        "segment_distance_km": F.when(F.col("_before").isNotNull(), step).otherwise(0.0),
    }).drop("_before", "_lat", "_lon")


def vessel_activity_summary(stg: DataFrame, layout: TrackLayout | None = None) -> DataFrame:
    """One row per (mmsi, day). Text columns are the lexical maximum of the day."""
    speed = F.col("speed_over_ground")
    change = F.col("speed_change_rate")
    turn = F.col("heading_change_degrees")
    gap = F.col("minutes_since_prev")
    in_port = F.coalesce("is_in_port_zone", F.lit(False))
    first, last = F.min("event_timestamp"), F.max("event_timestamp")
    # Only these columns go through the ranges of hot vessels, which are written.
    return day_segments(stg.select(*READ), layout).groupBy("mmsi", "date_day").agg(
        F.max("vessel_name").alias("vessel_name"),
        F.max("flag_country").alias("flag_country"),
        F.max("vessel_type_normalized").alias("vessel_type"),
        F.max("ocean_region").alias("primary_ocean_region"),
        F.count(F.lit(1)).alias("position_count"),
        F.count_distinct("port_name").alias("distinct_ports_visited"),
        F.count_if(in_port).alias("positions_in_port"),
        F.count_if(~in_port).alias("positions_at_sea"),
        first.alias("first_seen"),
        last.alias("last_seen"),
        elapsed("MINUTE", last, first).alias("active_minutes"),
        F.round(F.avg(speed), 2).alias("avg_speed_knots"),
        F.round(F.max(speed), 2).alias("max_speed_knots"),
        F.round(avg_if(speed > 0.5, speed), 2).alias("avg_underway_speed_knots"),
        F.count_if(speed < 0.5).alias("positions_stationary"),
        F.round(F.sum("segment_distance_km"), 2).alias("estimated_distance_km"),
        F.round(F.avg(change), 3).alias("avg_speed_change_rate"),
        F.round(F.max(change), 3).alias("max_speed_change_rate"),
        F.round(F.avg(turn), 3).alias("avg_heading_change"),
        F.round(F.max(turn), 3).alias("max_heading_change"),
        F.count_if(change > 5).alias("sudden_speed_changes"),
        F.count_if(turn > 45).alias("sharp_turns"),
        F.count_if(gap > 30).alias("ais_gaps_30min"),
        F.count_if(gap > 120).alias("ais_gaps_2hr"),
        F.max(gap).alias("max_ais_gap_minutes"),
        F.max("port_name").alias("last_known_port"),
        F.max("destination_clean").alias("declared_destination"),
        F.max("_source_system").alias("source_system"),
        F.max("_pipeline_version").alias("pipeline_version"),
        F.current_timestamp().alias("gold_processed_at"),
    )
