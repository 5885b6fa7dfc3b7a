"""Days on which a vessel turned sharply too often."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.functions.timeparts import surrogate_key
from wakeline.plans.day_ends import last_positions


def with_last_position(
    days: DataFrame, stg: DataFrame, ties: tuple[str, ...] = (), ends: DataFrame | None = None
) -> DataFrame:
    """Add the last position of each (mmsi, day), from the maintained ends of days or from the positions themselves.

    Positions are reduced to one row per day before the join.
    """
    if ends is not None:
        last = last_positions(ends)
    else:
        moment = F.struct("event_timestamp", *ties)
        last = stg.groupBy("mmsi", "date_day").agg(
            F.max_by(F.struct("latitude", "longitude", "event_timestamp"), moment).alias("_last")
        )
    return (
        days.join(last, ["mmsi", "date_day"], "left")
        .withColumns({
            "latitude": F.col("_last.latitude"),
            "longitude": F.col("_last.longitude"),
            "last_position_timestamp": F.col("_last.event_timestamp"),
        })
        .drop("_last")
    )


def vessel_erratic_course(
    activity: DataFrame, stg: DataFrame, ties: tuple[str, ...] = (), ends: DataFrame | None = None
) -> DataFrame:
    """More than 10 sharp turns in a day while moving (average above 1 knot)."""
    turns = F.col("sharp_turns")
    text = F.concat(
        turns.cast("string"),
        F.lit(" sharp turns (>45°) detected — avg heading change: "),
        F.round("avg_heading_change", 1).cast("string"),
        F.lit("°"),
    )
    days = activity.filter((turns > 10) & (F.col("avg_speed_knots") > 1)).select(
        "mmsi", "date_day", "vessel_name", "flag_country", "vessel_type",
        F.col("primary_ocean_region").alias("ocean_region"), "last_known_port",
        F.when(turns > 20, "high").otherwise("medium").alias("severity"),
        "sharp_turns", "avg_heading_change", text.alias("description"), "avg_speed_knots",
    )
    placed = with_last_position(days, stg, ties, ends)
    return placed.select(
        surrogate_key(F.col("mmsi"), F.col("date_day")).alias("alert_id"),
        *days.columns,
        "latitude", "longitude", "last_position_timestamp",
        F.current_timestamp().alias("gold_processed_at"),
    )
