"""The first and the last row and the last port of each vessel and day: one small table that several models read
instead of silver."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.operators.dedup import last_known
from wakeline.operators.incremental import before, since


def day_ends(stg: DataFrame, ties: tuple[str, ...] = ()) -> DataFrame:
    """(mmsi, date_day, first, last, port): combined on the map side, so a task sends a row for each vessel and day at most."""
    moment = F.struct("event_timestamp", *ties)
    return stg.groupBy("mmsi", "date_day").agg(
        F.min_by(F.struct(*stg.columns), moment).alias("first"),
        F.max_by(F.struct(*stg.columns), moment).alias("last"), last_known(F.col("port_name"), moment).alias("port"))


def seeds_before(ends: DataFrame, stg: DataFrame, cutoff: datetime, ties: tuple[str, ...] = ()) -> DataFrame:
    """Each vessel's last row before the cutoff: from the ends of earlier days, and the rows of the cutoff's own day."""
    midnight = datetime(cutoff.year, cutoff.month, cutoff.day)
    older = ends.where(F.col("date_day") < F.lit(midnight.date().isoformat()).cast("date")).select("last.*")
    rows = older.unionByName(before(since(stg, midnight), cutoff).select(*older.columns))
    newest = F.max_by(F.struct(*rows.columns), F.struct("event_timestamp", *ties))
    return rows.groupBy("mmsi").agg(newest.alias("_row")).select("_row.*")


def roster(ends: DataFrame, ties: tuple[str, ...] = ()) -> DataFrame:
    """Identity of each vessel from its newest row, and the last port it was seen in."""
    newest = F.max_by(
        F.struct("last.vessel_name", "last.vessel_type_normalized", "last.flag_country"),
        F.struct("last.event_timestamp", *[f"last.{c}" for c in ties]))
    return (
        ends.groupBy("mmsi").agg(newest.alias("_newest"), last_known(F.col("port"), F.col("date_day")).alias("last_known_port"))
        .select("mmsi", "_newest.*", "last_known_port")
    )


def last_positions(ends: DataFrame) -> DataFrame:
    """(mmsi, date_day, _last): where each vessel was at the end of each day."""
    return ends.select("mmsi", "date_day", F.struct("last.latitude", "last.longitude", "last.event_timestamp").alias("_last"))
