"""Keep one row per key; hot groups of copies shrink to one row per task before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top1(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of every group. The ``row_number() = 1`` form lets Spark keep the group's best row on the
    map side (WindowGroupLimit), so a group of any size sends one row per task."""
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str] = ("mmsi", "event_timestamp"),
    latest_by: Sequence[str] = ("ingestion_timestamp",),
) -> DataFrame:
    return top1(df, keys, [F.desc(c) for c in latest_by])


def last_known(value: Column, order: Column) -> Column:
    """Aggregate: the non-null ``value`` with the highest ``order`` in the group."""
    return F.max_by(value, F.when(value.isNotNull(), order))
