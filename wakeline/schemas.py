"""Declared schemas as (column, SQL type) lists. Every column is nullable.

Names and types are FIXED VALUES: producers and stored tables use exactly these.
"""

from __future__ import annotations

Fields = list[tuple[str, str]]


def ddl(fields: Fields) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in fields)


def names(fields: Fields) -> list[str]:
    return [name for name, _ in fields]


def _struct(fields: Fields) -> str:
    return "struct<" + ", ".join(f"`{name}`: {kind}" for name, kind in fields) + ">"


POSITION_REPORT: Fields = [
    ("Cog", "double"), ("CommunicationState", "int"), ("Latitude", "double"), ("Longitude", "double"),
    ("MessageID", "int"), ("NavigationalStatus", "int"), ("PositionAccuracy", "boolean"), ("Raim", "boolean"),
    ("RateOfTurn", "int"), ("RepeatIndicator", "int"), ("Sog", "double"), ("Spare", "int"),
    ("SpecialManoeuvreIndicator", "int"), ("Timestamp", "int"), ("TrueHeading", "int"), ("UserID", "int"),
    ("Valid", "boolean"),
]

SHIP_STATIC: Fields = [
    ("UserID", "int"), ("Type", "int"), ("ImoNumber", "int"), ("Callsign", "string"), ("Name", "string"),
    ("Destination", "string"), ("MaximumStaticDraught", "float"),
]

# Raw messages as they arrive.
RAW_POSITION: Fields = [
    ("Message", _struct([("PositionReport", _struct(POSITION_REPORT))])),
    ("MessageType", "string"),
    ("MetaData", _struct([
        ("MMSI", "bigint"), ("MMSI_String", "bigint"), ("ShipName", "string"), ("time_utc", "string"),
        ("latitude", "double"), ("longitude", "double"),
    ])),
]
RAW_STATIC: Fields = [
    ("Message", _struct([("ShipStaticData", _struct(SHIP_STATIC))])),
    ("MessageType", "string"),
    ("MetaData", _struct([("MMSI", "bigint"), ("ShipName", "string")])),
]
# Both message kinds at once, for routing a mixed feed.
RAW_MESSAGE: Fields = [
    ("Message", _struct([("PositionReport", _struct(POSITION_REPORT)), ("ShipStaticData", _struct(SHIP_STATIC))])),
    ("MessageType", "string"),
    ("MetaData", _struct([
        ("MMSI", "bigint"), ("MMSI_String", "bigint"), ("ShipName", "string"), ("time_utc", "string"),
        ("latitude", "double"), ("longitude", "double"),
    ])),
]

BRONZE_POSITIONS: Fields = [
    *POSITION_REPORT,
    ("MMSI", "string"), ("MMSI_String", "string"), ("ShipName", "string"), ("time_utc", "timestamp"),
    ("ingestion_timestamp", "timestamp"), ("_source_system", "string"), ("_batch_id", "string"),
    ("_pipeline_version", "string"), ("_ingestion_date", "date"), ("_source_file", "string"),
]
BRONZE_POSITION_PARTITIONS: Fields = [("partition_date", "date"), ("partition_hour", "int")]

# What the metadata silver stage reads; other lineage columns are ignored.
BRONZE_METADATA_INPUT: Fields = [
    ("MMSI", "string"), ("ShipName", "string"), ("Type", "int"), ("ImoNumber", "int"), ("Callsign", "string"),
    ("Name", "string"), ("Destination", "string"), ("MaximumStaticDraught", "float"),
    ("ingestion_timestamp", "timestamp"),
]
BRONZE_METADATA: Fields = [
    *BRONZE_METADATA_INPUT,
    ("_source_system", "string"), ("_batch_id", "string"), ("_pipeline_version", "string"),
]

SILVER_POSITIONS: Fields = [
    ("mmsi", "string"), ("vessel_name", "string"), ("flag_country", "string"),
    ("latitude", "double"), ("longitude", "double"), ("ocean_region", "string"),
    ("port_name", "string"), ("port_country", "string"), ("is_in_port_zone", "boolean"),
    ("distance_to_port_km", "double"),
    ("speed_over_ground", "double"), ("course_over_ground", "double"), ("heading", "int"),
    ("navigational_status", "string"), ("speed_change_rate", "double"), ("heading_change_degrees", "double"),
    ("event_timestamp", "timestamp"), ("processing_timestamp", "timestamp"),
    ("_source_system", "string"), ("_source_file", "string"), ("_bronze_batch_id", "string"),
    ("_pipeline_version", "string"),
]
SILVER_METADATA: Fields = [
    ("mmsi", "string"), ("vessel_name", "string"), ("vessel_type_normalized", "string"),
    ("imo_number", "string"), ("callsign", "string"), ("destination_clean", "string"),
    ("draught", "float"), ("flag_country", "string"), ("source_system", "string"),
    ("processing_timestamp", "timestamp"),
]
SILVER_BATCH: Fields = [("_silver_batch_id", "string")]
DAY_PARTITION: Fields = [("partition_date", "date")]

# Live alerts: narrow input, output and per-vessel state.
ALERT_INPUT: Fields = [
    ("MMSI", "string"), ("Latitude", "double"), ("Longitude", "double"), ("Sog", "double"), ("time_utc", "string"),
]
ALERTS: Fields = [
    ("mmsi", "string"), ("alert_type", "string"), ("severity", "string"), ("description", "string"),
    ("latitude", "double"), ("longitude", "double"), ("detected_at", "string"),
]
ALERT_STATE: Fields = [
    ("last_lat", "double"), ("last_lon", "double"), ("last_sog", "double"), ("last_time_utc", "string"),
]

AUDIT: Fields = [
    ("layer", "string"), ("epoch_id", "bigint"), ("batch_id", "string"), ("rows_read", "bigint"),
    ("rows_written", "bigint"), ("rows_rejected", "bigint"), ("rows_other", "bigint"), ("rows_copies", "bigint"),
    ("invalid_json", "bigint"), ("missing_mmsi", "bigint"), ("invalid_position", "bigint"), ("invalid_time", "bigint"),
    ("duration_ms", "bigint"), ("finished_at", "timestamp"),
]

# Layer tables registered over the stored folders: columns, then partition columns.
LAYERS: dict[str, tuple[Fields, Fields]] = {
    "bronze_positions": (BRONZE_POSITIONS, BRONZE_POSITION_PARTITIONS),
    "bronze_metadata": (BRONZE_METADATA, DAY_PARTITION),
    "silver_positions": (SILVER_POSITIONS + SILVER_BATCH, DAY_PARTITION),
    "silver_metadata": (SILVER_METADATA + SILVER_BATCH, DAY_PARTITION),
}
