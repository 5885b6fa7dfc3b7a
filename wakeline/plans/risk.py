"""Thirty-day risk score per vessel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline import refdata as ref
from wakeline.functions.timeparts import as_day
from wakeline.operators.dedup import last_known
from wakeline.operators.incremental import trailing_days


def severity_points(severity: Column) -> Column:
    points = F.lit(1)
    for name, value in ref.DARK_SEVERITY_POINTS.items():
        points = F.when(severity == name, value).otherwise(points)
    return points


def dark_30d(dark: DataFrame, as_of=None) -> DataFrame:
    return trailing_days(dark, "event_date", as_of).groupBy("mmsi").agg(
        F.count(F.lit(1)).alias("dark_events"),
        F.sum(severity_points(F.col("severity"))).alias("dark_score"),
        F.count_if("reappeared_in_other_port").alias("port_change_gaps"),
    )


def speed_30d(speed: DataFrame, as_of=None) -> DataFrame:
    return trailing_days(speed, "event_date", as_of).groupBy("mmsi").agg(
        F.count(F.lit(1)).alias("speed_anomalies"),
        F.count_if(F.col("anomaly_type") == "GPS_SPOOFING").alias("spoofing_signals"),
        F.sum("speed_excess_knots").alias("total_excess_knots"),
    )


def loiter_30d(loiter: DataFrame, as_of=None) -> DataFrame:
    return trailing_days(loiter, "event_date", as_of).groupBy("mmsi").agg(
        F.count(F.lit(1)).alias("loiter_events"),
        F.sum("duration_minutes").alias("total_loiter_minutes"),
    )


def vessel_roster(stg: DataFrame, ties: tuple[str, ...] = ()) -> DataFrame:
    """Identity of each vessel from its newest row, and the last port it was seen in.

    Both are combined on the map side (``max_by``), so a vessel with very many rows costs one row per task.
    """
    moment = F.struct("event_timestamp", *ties)
    newest = F.max_by(F.struct("vessel_name", "vessel_type_normalized", "flag_country"), moment)
    return (
        stg.groupBy("mmsi")
        .agg(newest.alias("_newest"), last_known(F.col("port_name"), moment).alias("last_known_port"))
        .select("mmsi", "_newest.*", "last_known_port")
    )


def combine_risk_signals(vessels: DataFrame, dark: DataFrame, speed: DataFrame, loiter: DataFrame) -> DataFrame:
    """Left joins of sides that all hold one row per vessel."""
    signals = vessels.join(dark, "mmsi", "left").join(speed, "mmsi", "left").join(loiter, "mmsi", "left")
    return signals.na.fill(0, subset=[*ref.RISK_WEIGHTS, "dark_events"])


def vessel_risk_score(
    stg: DataFrame, dark: DataFrame, speed: DataFrame, loiter: DataFrame, as_of=None, ties: tuple[str, ...] = (),
    vessels: DataFrame | None = None,
) -> DataFrame:
    """``vessels`` is the roster if a maintained table has it; else it is made from all positions."""
    signals = combine_risk_signals(
        vessel_roster(stg, ties) if vessels is None else vessels, dark_30d(dark, as_of), speed_30d(speed, as_of), loiter_30d(loiter, as_of)
    ).filter(F.col("dark_score") + F.col("speed_anomalies") + F.col("loiter_events") > 0)
    score = sum((F.col(name) * weight for name, weight in ref.RISK_WEIGHTS.items()), F.lit(0))
    day = as_day(as_of)
    return signals.select(
        F.md5(F.concat("mmsi", day.cast("string"))).alias("score_id"),
        "mmsi", "vessel_name", "vessel_type_normalized", "flag_country", "last_known_port",
        F.col("dark_events").alias("dark_events_30d"),
        F.col("port_change_gaps").alias("port_change_gaps_30d"),
        F.col("speed_anomalies").alias("speed_anomalies_30d"),
        F.col("spoofing_signals").alias("spoofing_signals_30d"),
        F.col("loiter_events").alias("loiter_events_30d"),
        score.alias("risk_score"),
        day.alias("score_date"),
    )
