"""Positions that imply an impossible speed, and abrupt speed changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline import refdata as ref
from wakeline.functions.geo import haversine_nm
from wakeline.functions.lookup import speed_limit
from wakeline.functions.timeparts import elapsed, event_id
from wakeline.operators.incremental import incremental_cutoff, since
from wakeline.operators.sequence import TrackLayout, with_previous
from wakeline.plans.dark import recent_with_seeds
from wakeline.plans.late import JUDGED, judged

LOOKBACK_HOURS = 2


def anomaly_type(over_limit: Column, change: Column) -> Column:
    """Over the limit with an abrupt change is spoofing, over the limit alone impossible, else acceleration."""
    return (
        F.when(over_limit & (change > ref.SPOOFING_SPEED_CHANGE), "GPS_SPOOFING")
        .when(over_limit, "IMPOSSIBLE_SPEED")
        .otherwise("SUDDEN_ACCELERATION")
    )


def with_speed_limit(df: DataFrame) -> DataFrame:
    return df.withColumn("type_max_speed", speed_limit(F.col("vessel_type_normalized")))


def vessel_speed_anomalies(
    stg: DataFrame,
    target: DataFrame | None = None,
    compat: bool = False,
    ties: tuple[str, ...] = (),
    layout: TrackLayout | None = None,
    seeds: DataFrame | None = None,
) -> DataFrame:
    """One row per anomaly. ``target``, ``compat`` and ``seeds`` work as in ``vessel_dark_events``."""
    wanted = stg.select(
        "mmsi", "vessel_name", "vessel_type_normalized", "flag_country", "ocean_region", "port_country",
        "event_timestamp", F.col("date_day").alias("event_date"), F.col("speed_over_ground").alias("reported_sog"),
        "speed_change_rate", "latitude", "longitude", *ties,
        *[c for c in ("partition_date", JUDGED) if c in stg.columns],
    )
    if target is not None:
        cutoff = incremental_cutoff(target, "event_timestamp", LOOKBACK_HOURS)
        wanted = since(wanted, cutoff) if compat else recent_with_seeds(wanted, cutoff, ties, seeds)
    ordered = with_previous(
        wanted, {"_lat": "latitude", "_lon": "longitude", "_before": "event_timestamp"}, ties=ties, layout=layout
    )
    seconds = elapsed("SECOND", F.col("event_timestamp"), F.col("_before"))
    timed = judged(ordered).withColumn("_seconds", seconds).filter((F.col("_seconds") > 0) & F.col("_lat").isNotNull())
    if target is not None and not compat:
        timed = since(timed, cutoff)
    miles = haversine_nm(F.col("_lat"), F.col("_lon"), F.col("latitude"), F.col("longitude"))
    knots = F.try_divide(miles, F.col("_seconds") / 3600.0)
    rated = with_speed_limit(timed.withColumn("calculated_speed_knots", knots))
    excess = F.col("calculated_speed_knots") - F.col("type_max_speed")
    over = F.col("calculated_speed_knots") > F.col("type_max_speed")
    change = F.abs("speed_change_rate")
    found = rated.filter(over | (change > ref.SUDDEN_SPEED_CHANGE))
    return found.select(
        event_id(F.col("mmsi"), F.col("event_timestamp")).alias("anomaly_id"),
        "mmsi", "vessel_name", "vessel_type_normalized", "flag_country", "ocean_region", "port_country",
        "event_timestamp", "event_date", "reported_sog", "calculated_speed_knots", "speed_change_rate",
        "type_max_speed",
        F.round(excess, 2).alias("speed_delta_knots"),
        F.greatest(excess, F.lit(0.0)).alias("speed_excess_knots"),
        "latitude", "longitude",
        anomaly_type(over, change).alias("anomaly_type"),
    )
