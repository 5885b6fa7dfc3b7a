"""Cutoffs and seeds for refreshing a table from recent data only."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EPOCH = datetime(1970, 1, 1)


def incremental_cutoff(target: DataFrame | None, column: str, hours: int) -> datetime:
    """max(column) minus the lookback, or 1970 for a missing or empty target.

    One value leaves the cluster, as text so that the driver's own time zone cannot shift it.
    """
    if target is None:
        return EPOCH
    newest = target.agg(F.date_format(F.max(column), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("m")).first()["m"]
    if newest is None:
        return EPOCH
    return datetime.strptime(newest, "%Y-%m-%d %H:%M:%S.%f") - timedelta(hours=hours)


def since(df: DataFrame, cutoff: datetime, time: str = "event_timestamp", day: str = "partition_date") -> DataFrame:
    """Rows from ``cutoff`` on. The same bound goes to the partition column, so old folders are not listed."""
    df = df.filter(F.col(time) >= F.lit(cutoff.isoformat(" ")).cast("timestamp"))
    if day in df.columns:
        df = df.filter(F.col(day) >= F.lit(cutoff.date().isoformat()).cast("date"))
    return df


def before(df: DataFrame, cutoff: datetime, time: str = "event_timestamp", day: str = "partition_date") -> DataFrame:
    df = df.filter(F.col(time) < F.lit(cutoff.isoformat(" ")).cast("timestamp"))
    if day in df.columns:
        df = df.filter(F.col(day) <= F.lit(cutoff.date().isoformat()).cast("date"))
    return df


def trailing_days(df: DataFrame, column: str, as_of, days: int = 30) -> DataFrame:
    from wakeline.functions.timeparts import as_day

    return df.filter(F.col(column) >= F.date_sub(as_day(as_of), days))
