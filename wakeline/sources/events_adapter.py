"""Positions and static data derived from the generic ``events`` and ``orders`` tables.

Only integer arithmetic and literals are used, so another engine computes bit-identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline import refdata as ref
from wakeline import schemas

# FIXED VALUES of the derived data: country digits by user_id % 10 (999 has no flag, 099 is no ship),
# and the two time origins in microseconds.
MID_OF_USER = ["244", "366", "211", "257", "232", "636", "248", "412", "999", "099"]
ORIGIN = "2024-01-01 00:00:00"
TIME_SHRINK = 10
AS_OF = "2024-01-04 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _mmsi(user: str) -> str:
    mids = ", ".join(f"'{m}'" for m in MID_OF_USER)
    return f"concat(element_at(array({mids}), CAST({user} % 10 + 1 AS INT)), lpad(CAST({user} AS STRING), 6, '0'))"


def _port_centre(field: int) -> str:
    return f"element_at(array({', '.join(f'{p[field]!r}D' for p in ref.PORT_BOXES)}), p + 1)"


def bronze_from_events(events: DataFrame) -> DataFrame:
    """Bronze position rows, one per event; ``_row_id`` is the tie-break."""
    origin = f"unix_micros(TIMESTAMP'{ORIGIN}')"
    base = events.selectExpr(
        "event_id", "user_id", "event_type", "value", "CAST(get_json_object(props, '$.k') AS INT) AS k",
        f"timestamp_micros({origin} + (unix_micros(CAST(ts AS TIMESTAMP)) - {origin}) div {TIME_SHRINK}) AS t",
    ).selectExpr("*", f"CAST((user_id + dayofmonth(t)) % {len(ref.PORT_BOXES)} AS INT) AS p")
    near = "WHEN event_type IN ('click', 'view') THEN (k - 50) / 1000.0D"
    filled = {
        "Cog": "IF(k = 97, 360.0D, (event_id * 53 % 3600) / 10.0D)",
        "Latitude": f"{_port_centre(0)} + CASE {near} WHEN event_type = 'purchase' THEN 1.0D + k / 2000.0D ELSE k / 40.0D END",
        "Longitude": f"{_port_centre(1)} + CASE {near} WHEN event_type = 'purchase' THEN 1.0D ELSE -k / 50.0D END",
        "NavigationalStatus": "event_id % 16",
        "Sog": "IF(k = 99, 102.3D, value * 0.19371D)",
        "TrueHeading": "IF(k = 98, 511, (event_id * 37 + k * 11) % 360)",
        "UserID": "user_id",
        "Valid": "true",
        "MMSI": _mmsi("user_id"),
        "ShipName": "concat('VESSEL ', user_id, ' ')",
        "time_utc": "t",
        "ingestion_timestamp": "t + INTERVAL 5 SECONDS",
        "_source_system": f"'{ref.SOURCE_SYSTEM}'",
        "_batch_id": "event_id % 50",
        "_pipeline_version": f"'{ref.PIPELINE_VERSION}'",
    }
    columns = [f"CAST({filled.get(name, 'NULL')} AS {kind}) AS `{name}`" for name, kind in schemas.BRONZE_POSITIONS]
    return base.selectExpr(*columns, "event_id AS _row_id")


def with_replayed_rows(bronze: DataFrame) -> DataFrame:
    """Add a later copy of every twentieth row: what a replayed batch leaves behind."""
    copies = bronze.filter(F.col("_row_id") % 20 == 0).withColumns({
        "ingestion_timestamp": F.col("ingestion_timestamp") + F.expr("interval 60 seconds"),
        "_batch_id": F.concat(F.lit("r"), F.col("_batch_id")),
        "ShipName": F.concat(F.lit("LATE "), F.col("ShipName")),
        "_row_id": F.col("_row_id") + 1_000_000_000_000,
    })
    return bronze.unionByName(copies)


def metadata_from_orders(orders: DataFrame) -> DataFrame:
    """Bronze static rows, one per order; arrival time is the order date, ``_row_id`` the tie-break."""
    return orders.selectExpr(
        f"{_mmsi('o_custkey')} AS MMSI",
        "concat(' SHIP ', o_custkey) AS ShipName",
        "CAST(o_custkey * 7 % 100 AS INT) AS Type",
        "CAST(o_custkey + 9000000 AS INT) AS ImoNumber",
        "concat('C', o_custkey) AS Callsign",
        "CAST(NULL AS STRING) AS Name",
        "IF(o_orderkey % 7 = 0, 'tba ', lower(o_orderpriority)) AS Destination",
        "CAST((o_orderkey % 150) / 10.0D AS FLOAT) AS MaximumStaticDraught",
        "CAST(o_orderdate AS TIMESTAMP) AS ingestion_timestamp",
        "o_orderkey AS _row_id",
    )


def boxes_from_customers(customers: DataFrame) -> DataFrame:
    """A box for each customer, of 0.1 to 5 degrees, many of them overlapping; the lower key ranks first."""
    key = F.col("c_custkey")
    lat, lon, half = (key * 37 % 1600) / 10.0 - 80.0, (key * 91 % 3500) / 10.0 - 175.0, 0.05 + (key % 50) / 20.0
    return customers.select(
        (lat - half).alias("south"), (lat + half).alias("north"), (lon - half).alias("west"), (lon + half).alias("east"),
        key.alias("rank"), key.alias("zone_id"), F.concat(F.lit("zone "), key).alias("zone"),
    )


def raw_messages(events: DataFrame) -> DataFrame:
    """JSON text of a mixed raw feed, one message per event (``event_id`` kept beside it).

    Some messages are static ones, of an unhandled type, not JSON, without MMSI or coordinates, or off the globe.
    """
    bronze = bronze_from_events(events).withColumn("e", F.col("_row_id"))
    e = F.col("e")
    user = F.when(e % 13 != 4, F.col("UserID"))
    report = F.struct(*[
        {
            "Latitude": F.when(e % 17 == 3, F.lit(91.0)).when(e % 17 != 5, F.col("Latitude")),
            "UserID": user,
            "CommunicationState": (e * 31 % 262_143).cast("int"), "MessageID": (1 + e % 3).cast("int"),
            "PositionAccuracy": e % 2 == 0, "Raim": e % 5 == 0, "RateOfTurn": (e % 255 - 127).cast("int"),
            "RepeatIndicator": (e % 4).cast("int"), "Spare": F.lit(0), "Timestamp": (e % 60).cast("int"),
            "SpecialManoeuvreIndicator": (e % 3).cast("int"),
        }.get(name, F.col(name)).alias(name)
        for name in schemas.names(schemas.POSITION_REPORT)
    ])
    static = F.struct(
        user.alias("UserID"), (e % 100).cast("int").alias("Type"), (e + 9_000_000).cast("int").alias("ImoNumber"),
        F.concat(F.lit("C"), e.cast("string")).alias("Callsign"), F.col("ShipName").alias("Name"),
        F.lit("ROTTERDAM").alias("Destination"), F.lit(7.5).cast("float").alias("MaximumStaticDraught"),
    )
    mmsi = F.when(e % 13 != 4, F.col("MMSI").cast("bigint"))
    meta = F.struct(
        mmsi.alias("MMSI"), mmsi.alias("MMSI_String"), F.col("ShipName"),
        F.concat(F.date_format("time_utc", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("123 +0000 UTC")).alias("time_utc"),
        F.when(e % 17 == 5, F.when(e % 2 == 0, F.col("Latitude"))).otherwise(F.col("Latitude")).alias("latitude"),
        F.col("Longitude").alias("longitude"),
    )
    kind = (
        F.when(e % 11 == 1, "ShipStaticData").when(e % 11 == 2, "BaseStationReport").otherwise("PositionReport")
    )
    message = F.struct(
        F.struct(
            F.when(kind == "PositionReport", report).alias("PositionReport"),
            F.when(kind == "ShipStaticData", static).alias("ShipStaticData"),
        ).alias("Message"),
        kind.alias("MessageType"),
        meta.alias("MetaData"),
    )
    return bronze.select(
        e.alias("event_id"), F.when(e % 19 == 7, F.lit("{broken")).otherwise(F.to_json(message)).alias("value")
    )
