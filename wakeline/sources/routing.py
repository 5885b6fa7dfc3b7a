"""Split a mixed raw feed into positions, static data and rejected messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline import refdata as ref
from wakeline import schemas
from wakeline.functions.timeparts import normalize_time
from wakeline.sources.streams import parse_once

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def _unless_zero(column):
    return F.nullif(column, F.lit(0).cast("double"))


def classify_messages(raw: DataFrame, column: str = "value", fallback_time=None) -> DataFrame:
    """Add the parsed message, ``route`` (positions, metadata or null) and ``reject_reason``.

    A zero or missing MMSI falls back to the report's UserID, a zero or missing coordinate to the envelope's. Only
    the time text of the payload is rewritten; unreadable times take ``fallback_time`` (default: now).
    """
    fields = [*schemas.RAW_MESSAGE, ("_corrupt_record", "string")]
    parsed = raw.select("*", parse_once(column, fields, {"columnNameOfCorruptRecord": "_corrupt_record"}))
    kind = F.col("MessageType")
    position, static, meta = F.col("Message.PositionReport"), F.col("Message.ShipStaticData"), F.col("MetaData")
    user = F.when(kind == "PositionReport", position["UserID"]).when(kind == "ShipStaticData", static["UserID"])
    mmsi = F.coalesce(F.nullif(meta["MMSI"], F.lit(0).cast("bigint")), user.cast("bigint"))
    lat = F.coalesce(_unless_zero(position["Latitude"]), meta["latitude"])
    lon = F.coalesce(_unless_zero(position["Longitude"]), meta["longitude"])
    on_globe = F.coalesce((F.abs(lat) <= 90) & (F.abs(lon) <= 180), F.lit(False))
    reason = (
        F.when(kind.isNull() & F.col("_corrupt_record").isNotNull(), "invalid_json")
        .when(kind.isNull() | ~kind.isin("PositionReport", "ShipStaticData"), "unhandled_type")
        .when(mmsi.isNull(), "missing_mmsi")
        .when((kind == "PositionReport") & ~on_globe, "invalid_position")
    )
    now = F.current_timestamp() if fallback_time is None else fallback_time
    iso = F.date_format(normalize_time(meta["time_utc"], now), ISO_MICROS)
    return (
        parsed.withColumn("reject_reason", reason)
        .withColumn(
            "route",
            F.when(F.col("reject_reason").isNull(), F.when(kind == "PositionReport", "positions").otherwise("metadata")),
        )
        .withColumn("MetaData", F.when(meta.isNotNull(), meta.withField("time_utc", iso)))
        .drop("_corrupt_record")
    )


def split_routes(routed: DataFrame, column: str = "value", source: str = ref.SOURCE_SYSTEM):
    """(positions, metadata, rejected) of a classified frame. Rejected rows carry the original text, the reason and
    the source."""
    payload = ["Message", "MessageType", "MetaData"]
    return (
        routed.filter("route = 'positions'").select(*payload),
        routed.filter("route = 'metadata'").select(*payload),
        routed.filter("route is null").select(
            F.col(column).alias("original_data"), F.col("reject_reason").alias("error"), F.lit(source).alias("source")
        ),
    )


def route_messages(
    raw: DataFrame, column: str = "value", source: str = ref.SOURCE_SYSTEM, fallback_time=None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Classify and split. When more than one part is used, persist ``classify_messages(raw)`` and call
    ``split_routes`` on it, so that each text is parsed once."""
    return split_routes(classify_messages(raw, column, fallback_time), column, source)
