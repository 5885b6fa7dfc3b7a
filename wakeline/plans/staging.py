"""Silver positions joined with each vessel's newest static data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline import refdata as ref
from wakeline.operators.dedup import top1
from wakeline.operators.joins import BROADCAST_ROWS, left_lookup
from wakeline.operators.sequence import TrackLayout

FROM_METADATA = ["vessel_type_normalized", "destination_clean", "imo_number", "callsign", "draught"]


def latest_metadata(meta: DataFrame, tie_break: tuple[str, ...] = ()) -> DataFrame:
    newest_first = [F.desc("processing_timestamp"), *[F.desc(c) for c in tie_break]]
    return top1(meta.filter(F.col("mmsi").isNotNull()), ["mmsi"], newest_first)


def with_latest_metadata(
    positions: DataFrame, meta: DataFrame, tie_break: tuple[str, ...] = (), broadcast_rows: int = BROADCAST_ROWS,
    layout: TrackLayout | None = None,
) -> DataFrame:
    """``layout``, made for the positions' vessels, tells which of them are hot, so that they are not counted again."""
    newest = latest_metadata(meta, tie_break).select("mmsi", *FROM_METADATA)
    vessels = meta.select("mmsi").distinct()  # as many rows as ``newest`` (or one more, for null)
    joined = left_lookup(positions, newest, "mmsi", F.col("event_timestamp"), vessels, broadcast_rows, layout=layout)
    category = F.coalesce("vessel_type_normalized", F.lit(ref.SHIP_TYPE_MISSING))
    return joined.withColumn("vessel_type_normalized", category)


def is_vessel_position():
    """A readable position of a ship; numbers starting with 0 are coast stations and group calls."""
    return (
        F.col("mmsi").isNotNull()
        & ~F.col("mmsi").startswith("0")
        & F.col("event_timestamp").isNotNull()
        & F.col("latitude").between(-90.0, 90.0)
        & F.col("longitude").between(-180.0, 180.0)
    )


def stg_vessel_positions(
    positions: DataFrame,
    meta: DataFrame,
    dedup: bool = False,
    meta_tie_break: tuple[str, ...] = (),
    broadcast_rows: int = BROADCAST_ROWS,
    layout: TrackLayout | None = None,
) -> DataFrame:
    """The staging view every gold model reads. ``dedup=True`` keeps the newest row per (mmsi, event time)."""
    kept = positions.filter(is_vessel_position())
    if dedup:
        kept = top1(
            kept, ["mmsi", "event_timestamp"], [F.desc("processing_timestamp"), F.desc("_bronze_batch_id")]
        )
    joined = with_latest_metadata(kept, meta, meta_tie_break, broadcast_rows, layout)
    return joined.withColumns({
        "date_day": F.to_date("event_timestamp"),
        "hour_of_day": F.hour("event_timestamp"),
    })
