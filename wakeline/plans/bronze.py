"""Raw messages -> typed, validated rows with lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline import refdata as ref
from wakeline import schemas


def flatten_positions(raw: DataFrame) -> DataFrame:
    """Nested position messages -> one flat row each; other message types are left out."""
    report = [F.col(f"Message.PositionReport.{name}").alias(name) for name in schemas.names(schemas.POSITION_REPORT)]
    return raw.filter(F.col("MessageType") == "PositionReport").select(
        *report,
        F.col("MetaData.MMSI").cast("string").alias("MMSI"),
        F.col("MetaData.MMSI_String").cast("string").alias("MMSI_String"),
        F.col("MetaData.ShipName").alias("ShipName"),
        F.col("MetaData.time_utc").alias("time_utc"),
        F.lit(ref.SOURCE_SYSTEM).alias("_source_system"),
    )


def flatten_metadata(raw: DataFrame) -> DataFrame:
    static = [n for n in schemas.names(schemas.SHIP_STATIC) if n != "UserID"]
    flat = raw.filter(F.col("MessageType") == "ShipStaticData").select(
        F.col("MetaData.MMSI").cast("string").alias("MMSI"),
        F.col("MetaData.ShipName").alias("ShipName"),
        *[F.col(f"Message.ShipStaticData.{name}").alias(name) for name in static],
    )
    return flat.filter(F.col("MMSI").isNotNull())


def is_possible_position():
    """Physically possible: an MMSI and coordinates on the globe (91 and 181 mean "not available")."""
    return (
        F.col("MMSI").isNotNull()
        & F.col("Latitude").between(-90.0, 90.0)
        & F.col("Longitude").between(-180.0, 180.0)
    )


def validate_positions(flat: DataFrame) -> DataFrame:
    return flat.filter(is_possible_position())


def rejected_positions(flat: DataFrame) -> DataFrame:
    """The rows ``validate_positions`` leaves out (a null test counts as failed)."""
    return flat.filter(~F.coalesce(is_possible_position(), F.lit(False)))


def position_faults() -> dict[str, Column]:
    """Why a parsed message of the feed does not become a bronze position, by reason; at most one is true. Messages of
    other kinds have none."""
    report, meta = F.col("Message.PositionReport"), F.col("MetaData")
    own = F.coalesce(F.col("MessageType") == "PositionReport", F.lit(False))
    on_globe = F.coalesce(report["Latitude"].between(-90.0, 90.0) & report["Longitude"].between(-180.0, 180.0), F.lit(False))
    named = own & meta["MMSI"].isNotNull()
    return {
        "invalid_json": F.col("MessageType").isNull(), "missing_mmsi": own & meta["MMSI"].isNull(),
        "invalid_position": named & ~on_globe,
        "invalid_time": named & on_globe & F.try_to_timestamp(meta["time_utc"]).isNull(),
    }


def metadata_faults() -> dict[str, Column]:
    own = F.coalesce(F.col("MessageType") == "ShipStaticData", F.lit(False))
    return {"invalid_json": F.col("MessageType").isNull(), "missing_mmsi": own & F.col("MetaData.MMSI").isNull()}


def add_position_lineage(
    flat: DataFrame, batch_id: str, version: str = ref.PIPELINE_VERSION, source_file: str | None = None
) -> DataFrame:
    """Typed event time, folder keys and lineage; rows whose time cannot be read are dropped."""
    return (
        flat.withColumn("time_utc", F.try_to_timestamp("time_utc"))
        .filter(F.col("time_utc").isNotNull())
        .withColumns({
            "ingestion_timestamp": F.current_timestamp(),
            "partition_date": F.to_date("time_utc"),
            "partition_hour": F.hour("time_utc"),
            "_batch_id": F.lit(batch_id),
            "_pipeline_version": F.lit(version),
            "_ingestion_date": F.current_date(),
            "_source_file": F.lit(source_file).cast("string"),
        })
    )


def add_metadata_lineage(flat: DataFrame, batch_id: str, version: str = ref.PIPELINE_VERSION) -> DataFrame:
    """Lineage of static messages, which carry no event time: the folder is the arrival date."""
    return flat.withColumns({
        "ingestion_timestamp": F.current_timestamp(),
        "_source_system": F.lit(ref.SOURCE_SYSTEM),
        "_batch_id": F.lit(batch_id),
        "_pipeline_version": F.lit(version),
        "partition_date": F.current_date(),
    })


def bronze_positions(raw: DataFrame, batch_id: str, **lineage) -> DataFrame:
    return add_position_lineage(validate_positions(flatten_positions(raw)), batch_id, **lineage)


def bronze_metadata(raw: DataFrame, batch_id: str, **lineage) -> DataFrame:
    return add_metadata_lineage(flatten_metadata(raw), batch_id, **lineage)
