"""JSON readers for topics and folders, and the JSON form used between stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline import schemas

#: A micro-batch from files takes about so much, as one from a topic takes so many offsets.
FILE_DEFAULTS = {"maxBytesPerTrigger": str(256 * 1024 * 1024)}
# FIXED VALUES: defaults of the topic reader.
KAFKA_DEFAULTS = {"startingOffsets": "earliest", "maxOffsetsPerTrigger": "4000", "failOnDataLoss": "false"}


def parse_json(df: DataFrame, fields: schemas.Fields, column: str = "value") -> DataFrame:
    """One flat row per JSON text. Only the fields of the schema are parsed; unknown ones are ignored, missing
    ones and malformed texts give nulls."""
    return df.select(parse_once(column, fields))


def parse_once(column: str, fields: schemas.Fields, options: dict | None = None) -> Column:
    """Generator giving the parsed fields as columns.

    As a generator the parse stays one step: filters and projections above it cannot pull copies of it apart.
    """
    return F.inline(F.array(F.from_json(F.col(column).cast("string"), schemas.ddl(fields), options)))


def read_json_stream(
    spark: SparkSession, source: str, fields: schemas.Fields, *, path: str | None = None,
    capped: bool = True, truncate_ms: bool = False, **options: str,
) -> DataFrame:
    """Stream of parsed messages.

    ``source="kafka"`` takes ``subscribe`` and ``kafka.bootstrap.servers`` options (the connector must be on the
    class path); ``source="text"`` reads a folder of JSON lines, ``source="json"`` one of keyed messages as
    ``to_keyed_json`` makes them. All are limited for each micro-batch, files by their size; ``capped=False`` removes
    the limit.
    ``truncate_ms`` cuts timestamps to the milliseconds that JSON between stages carries.
    """
    reader = spark.readStream.format(source)
    settings = dict(options)
    if source == "kafka":
        settings = {**KAFKA_DEFAULTS, **settings}
        if not capped:
            settings.pop("maxOffsetsPerTrigger", None)
    elif capped and "maxFilesPerTrigger" not in settings:
        settings = {**FILE_DEFAULTS, **settings}
    reader = reader.options(**settings)
    if source == "json":
        reader = reader.schema("key string, value string")
    messages = parse_json(reader.load(path) if path else reader.load(), fields)
    if not truncate_ms:
        return messages
    times = {n: F.date_trunc("MILLISECOND", F.col(n)) for n, kind in fields if kind == "timestamp"}
    return messages.withColumns(times) if times else messages


def to_keyed_json(df: DataFrame, key: str = "MMSI") -> DataFrame:
    """Key and JSON value columns, the shape topics take."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))
