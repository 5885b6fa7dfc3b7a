"""Signal gaps longer than two hours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.functions.geo import haversine_km
from wakeline.functions.timeparts import elapsed, event_id
from wakeline.operators.incremental import before, incremental_cutoff, since
from wakeline.operators.sequence import TrackLayout, with_previous
from wakeline.plans.late import JUDGED, judged

LOOKBACK_HOURS = 6
GAP_MINUTES = 120


def recent_with_seeds(stg: DataFrame, cutoff, ties: tuple[str, ...] = (), seeds: DataFrame | None = None) -> DataFrame:
    """Rows since ``cutoff`` plus each vessel's last row before it, so the first gap keeps its start.

    The last rows come from ``seeds`` when a maintained table has them, else from one combined pass over the
    older rows.
    """
    if seeds is None:
        packed = F.max_by(F.struct(*stg.columns), F.struct("event_timestamp", *ties))
        seeds = before(stg, cutoff).groupBy("mmsi").agg(packed.alias("_row")).select("_row.*")
    return since(stg, cutoff).unionByName(seeds.select(*stg.columns))


def vessel_dark_events(
    stg: DataFrame,
    target: DataFrame | None = None,
    compat: bool = False,
    ties: tuple[str, ...] = (),
    layout: TrackLayout | None = None,
    seeds: DataFrame | None = None,
) -> DataFrame:
    """Gaps between consecutive positions of a vessel.

    With ``target`` only gaps that ended since max(signal_recovered_at) - 6 h are computed. ``compat=True`` looks
    at no row before that moment (a gap that began earlier is then missed); the default seeds it. Of rows made by
    ``late.affected_rows`` those to be judged are.
    """
    wanted = stg.select(
        "mmsi", "vessel_name", "flag_country", "vessel_type_normalized", "latitude", "longitude", "ocean_region",
        "port_name", "port_country", "event_timestamp", *ties,
        *[c for c in ("partition_date", JUDGED) if c in stg.columns],
    )
    if target is not None:
        cutoff = incremental_cutoff(target, "signal_recovered_at", LOOKBACK_HOURS)
        wanted = since(wanted, cutoff) if compat else recent_with_seeds(wanted, cutoff, ties, seeds)
    ordered = with_previous(
        wanted,
        {"signal_lost_at": "event_timestamp", "last_known_lat": "latitude",
         "last_known_lon": "longitude", "last_known_port": "port_name"},
        ties=ties, layout=layout,
    )
    recovered = F.col("event_timestamp")
    gaps = judged(ordered).withColumn("gap_minutes", elapsed("MINUTE", recovered, F.col("signal_lost_at"))).filter(
        (F.col("gap_minutes") > GAP_MINUTES) & F.col("last_known_lat").isNotNull()
    )
    if target is not None and not compat:
        gaps = since(gaps, cutoff)  # a seed row may itself end an older, already stored gap
    moved = haversine_km(
        F.col("last_known_lat"), F.col("last_known_lon"), F.col("latitude"), F.col("longitude")
    )
    events = gaps.select(
        event_id(F.col("mmsi"), recovered).alias("dark_event_id"),
        "mmsi", "vessel_name", "flag_country", "vessel_type_normalized", "signal_lost_at",
        recovered.alias("signal_recovered_at"), "gap_minutes", "last_known_lat", "last_known_lon",
        F.col("latitude").alias("reappearance_lat"), F.col("longitude").alias("reappearance_lon"),
        "ocean_region", "port_country", "last_known_port", F.col("port_name").alias("reappearance_port"),
        moved.alias("displacement_km"), F.to_date(recovered).alias("event_date"),
    )
    gap, km = F.col("gap_minutes"), F.col("displacement_km")
    other_port = F.col("port_country").isNotNull() & (F.col("reappearance_port") != F.col("last_known_port"))
    return events.withColumns({
        "severity": F.when((gap > 720) & (km > 100), "CRITICAL").when((gap > 360) & (km > 50), "HIGH").otherwise("MEDIUM"),
        "reappeared_in_other_port": F.coalesce(other_port, F.lit(False)),
    })
