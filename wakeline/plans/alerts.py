"""Alert rules as Column expressions: replay of the live path over stored positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline import refdata as ref
from wakeline import schemas
from wakeline.functions.clean import clean_sog
from wakeline.functions.geo import haversine_nm
from wakeline.functions.timeparts import as_timestamp, seconds_between, stamp
from wakeline.operators.sequence import TrackLayout, with_previous


def has_coordinates() -> Column:
    lat, lon = F.col("Latitude"), F.col("Longitude")
    return lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)


def alert_text(speed: Column, sog: Column, change: Column) -> Column:
    reported = F.coalesce(sog.cast("string"), F.lit("None"))
    return F.format_string("calculated_speed=%.1fkn reported_sog=%skn speed_change=%.1fkn", speed, reported, change)


def vessel_alerts_batch(bronze: DataFrame, ties: tuple[str, ...] = (), layout: TrackLayout | None = None) -> DataFrame:
    """Compare every position with the vessel's previous one; same rules and columns as the stream.

    Elapsed time is fractional here, and an unknown speed is no evidence of a speed change.
    """
    usable = bronze.filter(has_coordinates() & F.col("time_utc").isNotNull()).select(
        F.col("MMSI").alias("mmsi"), F.col("Latitude").alias("latitude"), F.col("Longitude").alias("longitude"),
        clean_sog(F.col("Sog")).alias("sog"), F.col("time_utc").alias("seen_at"), *ties,
    )
    track = with_previous(
        usable, {"_lat": "latitude", "_lon": "longitude", "_sog": "sog", "_seen": "seen_at"},
        time="seen_at", ties=ties, layout=layout,
    )
    hours = seconds_between(F.col("seen_at"), F.col("_seen")) / 3600.0
    timed = track.withColumn("_hours", hours).filter("_hours > 0")
    miles = haversine_nm(F.col("_lat"), F.col("_lon"), F.col("latitude"), F.col("longitude"))
    rated = timed.withColumns({
        "_speed": miles / F.col("_hours"),
        "_change": F.coalesce(F.abs(F.col("sog") - F.col("_sog")), F.lit(0.0)),
    })
    over = F.col("_speed") > ref.ALERT_SPEED_LIMIT_KNOTS
    kind = (
        F.when(over & (F.col("_change") > ref.SPOOFING_SPEED_CHANGE), "GPS_SPOOFING")
        .when(over, "IMPOSSIBLE_SPEED")
        .when(F.col("_change") > ref.SUDDEN_SPEED_CHANGE, "SUDDEN_ACCELERATION")
    )
    alerts = rated.withColumn("alert_type", kind).filter(F.col("alert_type").isNotNull())
    return alerts.select(
        "mmsi", "alert_type",
        F.when(F.col("alert_type") == "SUDDEN_ACCELERATION", "medium").otherwise("high").alias("severity"),
        alert_text(F.col("_speed"), F.col("sog"), F.col("_change")).alias("description"),
        "latitude", "longitude", stamp(F.col("seen_at")).alias("detected_at"),
    ).select(*schemas.names(schemas.ALERTS))


def silent_vessels(
    bronze: DataFrame, as_of, minutes: int = ref.SILENCE_MINUTES, ties: tuple[str, ...] = ()
) -> DataFrame:
    """Vessels not heard for ``minutes`` before ``as_of``, with their last position: the batch twin of AIS_GAP."""
    usable = bronze.filter(has_coordinates() & F.col("time_utc").isNotNull())
    last = usable.groupBy(F.col("MMSI").alias("mmsi")).agg(
        F.max_by(F.struct("Latitude", "Longitude", "time_utc"), F.struct("time_utc", *ties)).alias("_last")
    )
    deadline = as_timestamp(as_of) - F.expr(f"interval {int(minutes)} minutes")
    return last.filter(F.col("_last.time_utc") < deadline).select(
        "mmsi", F.lit("AIS_GAP").alias("alert_type"), F.lit("medium").alias("severity"),
        F.concat(
            F.lit(f"No messages for >{minutes} min — last seen at "), stamp(F.col("_last.time_utc"))
        ).alias("description"),
        F.col("_last.Latitude").alias("latitude"), F.col("_last.Longitude").alias("longitude"),
        F.col("_last.time_utc").alias("last_seen_at"),
    )
