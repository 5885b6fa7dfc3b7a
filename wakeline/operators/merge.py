"""Keyed merge (upsert) as a join, and its application to a day-partitioned table."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.sources import snapshots
from wakeline.sources.storage import Storage


def merge_upsert(target: DataFrame, updates: DataFrame, key: str, sync_schema: bool = False) -> DataFrame:
    """Rows of ``updates`` plus the rows of ``target`` whose key they do not carry.

    With ``sync_schema`` the result has exactly the columns of ``updates``: new ones are null in kept rows, dropped
    ones disappear. Without it the two column sets must agree.
    """
    kept = target.join(updates.select(key), key, "left_anti")
    if not sync_schema:
        return kept.select(*target.columns).unionByName(updates)
    return kept.unionByName(updates, allowMissingColumns=True).select(*updates.columns)


def merge_into(
    spark: SparkSession, path: str, updates: DataFrame, key: str, partition_by: str, sync_schema: bool = False,
    sort_by: Sequence[str] = (), storage: Storage | None = None, whole_days: Sequence[str] = (), gone: DataFrame | None = None,
) -> None:
    """Upsert into a table partitioned by day, rewriting only the days the updates touch.

    A key must determine its day (event ids hash the event time), so no other day can hold a matching row. The updates
    are computed once, into a folder beside the table's data. The merged days become visible by one commit (see
    ``snapshots``): a job that dies at any point leaves the table as it was or as it should be, and can run again.

    Of ``whole_days`` (texts) the updates have all rows there are: stored rows that they do not bring again go. So do
    those whose key and day are in ``gone``.
    """
    storage = storage or Storage(spark, path)
    staged = f"{snapshots.DATA}/updates-{uuid.uuid4().hex}"
    snapshots.clean(storage)
    updates.write.partitionBy(partition_by).parquet(storage.at(staged))
    days = [d for d in storage.folders(staged) if "=" in d]
    updates = spark.read.schema(updates.schema).parquet(storage.at(staged)).select(*updates.columns) if days else updates.limit(0)
    replaced = {f"{partition_by}={day}" for day in whole_days}
    leaving = [] if gone is None else [f"{partition_by}={r[0]}" for r in gone.select(F.col(partition_by).cast("string")).distinct().collect()]
    touched = {*days, *replaced, *leaving}
    commit = snapshots.newest(storage)
    taken = [f.name for f in snapshots.outside(storage, commit) if f.name.split("/")[0] in touched]
    kept_days = sorted(touched - replaced)
    merged = updates
    if any(f.split("/")[0] in kept_days for f in taken) or any(d in commit.days for d in kept_days):
        stored = snapshots.read(spark, path, days=kept_days)
        if gone is not None:
            stored = stored.join(gone.select(key), key, "left_anti")
        merged = merge_upsert(stored, updates, key, sync_schema)

    def write(folder: str) -> None:
        (
            merged.hint("rebalance", partition_by).sortWithinPartitions(partition_by, *sort_by)
            .write.partitionBy(partition_by).parquet(folder)
        )

    snapshots.change(storage, write, merged.schema, lambda day: day not in touched, taken, keep_folders=[staged])
