"""Time arithmetic, time-of-day labels and hashed keys."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from wakeline import refdata as ref

STAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def normalize_time(text: Column, fallback: Column | None = None) -> Column:
    """Provider text such as ``2026-03-12 13:09:41.810776108 +0000 UTC`` -> timestamp (microseconds).

    Unreadable text becomes ``fallback`` (null by default); missing text stays null.
    """
    without_zone_name = F.regexp_replace(F.trim(text), r"\s*UTC$", "")
    with_colon = F.regexp_replace(without_zone_name, r"\s*([+-]\d{2}):?(\d{2})$", "$1:$2")
    parsed = F.try_to_timestamp(with_colon)
    if fallback is None:
        return parsed
    return F.when(text.isNull() | (text == ""), F.lit(None).cast("timestamp")).otherwise(
        F.coalesce(parsed, fallback)
    )


def elapsed(unit: str, later: Column, earlier: Column) -> Column:
    """Whole units between two timestamps, truncated."""
    return F.timestamp_diff(unit, earlier, later)


def seconds_between(later: Column, earlier: Column) -> Column:
    """Fractional seconds between two timestamps."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6)


def stamp(ts: Column) -> Column:
    """Timestamp text with all six fraction digits: stable input for hashed ids."""
    return F.date_format(ts, STAMP_FORMAT)


def event_id(mmsi: Column, ts: Column) -> Column:
    return F.md5(F.concat(mmsi, stamp(ts)))


def surrogate_key(*columns: Column) -> Column:
    parts = [F.coalesce(c.cast("string"), F.lit(ref.NULL_KEY_TEXT)) for c in columns]
    return F.md5(F.concat_ws("-", *parts))


def bucket_label(ts: Column, seconds: int = 300) -> Column:
    """HH:MM of the bucket a timestamp falls into; the date is dropped on purpose."""
    start = F.floor(F.unix_seconds(ts) / F.lit(seconds)) * F.lit(seconds)
    return F.date_format(F.timestamp_seconds(start), "HH:mm")


def as_timestamp(as_of: datetime | str | Column | None) -> Column:
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def as_day(as_of: date | datetime | str | Column | None) -> Column:
    return F.to_date(as_timestamp(as_of))
