"""Slow movement outside ports within one tenth-degree cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.functions.geo import tenth_degree
from wakeline.functions.timeparts import elapsed, event_id
from wakeline.operators.incremental import incremental_cutoff, since
from wakeline.operators.sequence import TrackLayout, with_latest, with_previous

LOOKBACK_HOURS = 4
IDENTITY = ["mmsi", "vessel_name", "vessel_type_normalized", "flag_country", "ocean_region"]


def loiter_candidates(stg: DataFrame) -> DataFrame:
    """0.1 to 4 knots, not declared anchored or moored, outside every port box (unknowns are kept)."""
    status = F.col("navigational_status")
    return stg.filter(
        F.col("speed_over_ground").between(0.1, 4.0)
        & (status.isNull() | ~status.isin("at_anchor", "moored"))
        & ~F.coalesce("is_in_port_zone", F.lit(False))
    ).select(
        *[c for c in IDENTITY if c in stg.columns], "event_timestamp", F.col("date_day").alias("event_date"),
        "speed_over_ground", "heading_change_degrees",
        tenth_degree(F.col("latitude")).alias("lat_cell"), tenth_degree(F.col("longitude")).alias("lon_cell"),
    )


def cell_days(stg: DataFrame) -> DataFrame:
    """The candidate rows of each vessel, cell and day as one row of sums: what stays over any days are made of.

    Of the identity all but the ship category, which comes from the newest static data.
    """
    rows = loiter_candidates(stg)
    turn = F.abs("heading_change_degrees")
    identity = [c for c in IDENTITY if c in rows.columns and c != "vessel_type_normalized"]
    return rows.groupBy(*identity, "lat_cell", "lon_cell", F.col("event_date").alias("date_day")).agg(
        F.min("event_timestamp").alias("begin"), F.max("event_timestamp").alias("end"), F.count(F.lit(1)).alias("positions"),
        F.sum("speed_over_ground").alias("speed_sum"), F.count("speed_over_ground").alias("speed_rows"),
        F.sum(turn).alias("turn_sum"), F.count(turn).alias("turn_rows"),
    )


def stays_of_days(days: DataFrame) -> DataFrame:
    """The stays that ``vessel_loitering`` finds in all rows, from ``cell_days`` with the ship category."""
    begin, end = F.min("begin"), F.max("end")
    stays = days.groupBy(*IDENTITY, "lat_cell", "lon_cell").agg(
        _zone().alias("loiter_zone"), begin.alias("window_start"), end.alias("window_end"),
        F.sum("positions").alias("position_count"), elapsed("MINUTE", end, begin).alias("duration_minutes"),
        F.try_divide(F.sum("speed_sum"), F.sum("speed_rows")).alias("avg_speed_knots"),
        F.try_divide(F.sum("turn_sum"), F.sum("turn_rows")).alias("avg_heading_change"),
        F.min("date_day").alias("event_date"),
    )
    return _long_stays(stays)


def _zone() -> Column:
    return F.concat(F.col("lat_cell").cast("string"), F.lit("_"), F.col("lon_cell").cast("string"))


def _long_stays(stays: DataFrame) -> DataFrame:
    minutes = F.col("duration_minutes")
    level = (
        F.when((minutes > 720) & (F.col("avg_heading_change") > 20), "HIGH").when(minutes > 360, "MEDIUM").otherwise("LOW")
    )
    return stays.filter(minutes > 180).select(
        event_id(F.col("mmsi"), F.col("window_start")).alias("loiter_event_id"), "*", level.alias("risk_level")
    )


def with_visits(rows: DataFrame, minutes: int, layout: TrackLayout | None = None) -> DataFrame:
    """Add ``visit``, the time at which the vessel's visit to its cell began.

    Gaps and islands: a visit goes on as long as the vessel's candidate rows stay in the cell and follow each other
    within ``minutes``. A row that begins one carries its own time, and the others take the latest of these.
    """
    cell = {"_lat": "lat_cell", "_lon": "lon_cell", "_before": "event_timestamp"}
    ties = ("lat_cell", "lon_cell")
    moved = ~(F.col("lat_cell").eqNullSafe(F.col("_lat")) & F.col("lon_cell").eqNullSafe(F.col("_lon")))
    gap = elapsed("MINUTE", F.col("event_timestamp"), F.col("_before")) > minutes
    begins = F.coalesce(F.col("_before").isNull() | moved | gap, F.lit(True))
    flagged = with_previous(rows, cell, ties=ties, layout=layout).withColumn("_begins", F.when(begins, F.col("event_timestamp")))
    return with_latest(flagged.drop(*cell), {"visit": "_begins"}, ties=ties, layout=layout).drop("_begins")


def vessel_loitering(
    stg: DataFrame, target: DataFrame | None = None, sessionize: int | None = None, layout: TrackLayout | None = None
) -> DataFrame:
    """Stays of more than 180 minutes per vessel and cell.

    All candidate rows of a vessel in a cell form one stay, however far apart. With ``sessionize`` every visit is a
    stay of its own: it ends when the vessel is seen in another cell or not seen for so many minutes.
    """
    if target is not None:
        stg = since(stg, incremental_cutoff(target, "window_start", LOOKBACK_HOURS))
    rows = loiter_candidates(stg)
    group = [*IDENTITY, "lat_cell", "lon_cell"]
    if sessionize is not None:
        rows, group = with_visits(rows, sessionize, layout), [*group, "visit"]
    begin, end = F.min("event_timestamp"), F.max("event_timestamp")
    stays = rows.groupBy(*group).agg(
        _zone().alias("loiter_zone"),
        begin.alias("window_start"),
        end.alias("window_end"),
        F.count(F.lit(1)).alias("position_count"),
        elapsed("MINUTE", end, begin).alias("duration_minutes"),
        F.avg("speed_over_ground").alias("avg_speed_knots"),
        F.avg(F.abs("heading_change_degrees")).alias("avg_heading_change"),
        F.min("event_date").alias("event_date"),
    )
    return _long_stays(stays.drop("visit"))
