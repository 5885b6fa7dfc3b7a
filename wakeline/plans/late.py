"""What late rows change: their own days, and the first row after each of these days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Whether a row's way from the row before it is to be looked at; rows without are there to be the row before.
JUDGED = "_judged"


def affected_rows(rows: DataFrame, ends: DataFrame, days: Sequence[str]) -> DataFrame:
    """The staging rows that tell all events which rows of the changed ``days`` can make, end or move.

    ``rows`` are those of the changed days. From ``ends``, the first and last rows of every vessel and day, come the last
    row before and the first row after each stretch of changed days. A vessel's other rows keep their neighbours, so
    history is not read, however late rows are.
    """
    changed = F.array(*[F.lit(day).cast("date") for day in days])
    known = ends.filter(~F.array_contains(changed, F.col("date_day")))
    track = Window.partitionBy("mmsi").orderBy("date_day")
    placed = known.withColumns({"_earlier": F.lag("date_day").over(track), "_later": F.lead("date_day").over(track)})

    def changed_between(low: Column, high: Column) -> Column:
        return F.exists(changed, lambda d: (low.isNull() | (d > low)) & (high.isNull() | (d < high)))

    def taken(which: str, where: Column, judged: bool) -> DataFrame:
        return placed.filter(where).select(f"{which}.*").select(*rows.columns).withColumn(JUDGED, F.lit(judged))

    before = taken("last", changed_between(F.col("date_day"), F.col("_later")), False)
    after = taken("first", changed_between(F.col("_earlier"), F.col("date_day")), True)
    return rows.withColumn(JUDGED, F.lit(True)).unionByName(before).unionByName(after)


def judged(rows: DataFrame) -> DataFrame:
    """The rows to be looked at; all of them if the frame does not say."""
    return rows.filter(JUDGED).drop(JUDGED) if JUDGED in rows.columns else rows
