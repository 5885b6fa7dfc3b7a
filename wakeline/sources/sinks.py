"""Writers of the layers, topics and gold tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.sources import snapshots
from wakeline.sources.storage import Storage
from wakeline.sources.streams import to_keyed_json

ROWS_PER_FILE = 5_000_000


def write_idempotent(
    df: DataFrame, path: str, epoch_id: int, partition_by: Sequence[str] = (), rows_per_file: int = ROWS_PER_FILE,
    ranges_by: Sequence[str] = (),
) -> None:
    """Write one micro-batch into its own ``<day>/batch=<epoch>`` folders, replacing what an earlier try left there.

    A batch that is processed again holds the same rows in the same days, so it replaces exactly its own folders. The
    day comes first in the path: readers prune by day, and a closed day can be compacted. Tasks get even shares of
    the rows: a small batch makes few files, a large one as many tasks and files as it needs.

    With ``ranges_by``, columns that the folders follow in order, the shares are ranges of these: a task writes to few
    of many folders, and there are about as many files as tasks and folders, not as many as their product. The bounds
    come from a sample, so the rows should be persisted.
    """
    spread = df.repartitionByRange(*ranges_by) if ranges_by else df.hint("rebalance")
    (
        spread.withColumn("batch", F.lit(str(epoch_id)))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*partition_by, "batch").parquet(path)
    )


def first_clock(spark: SparkSession, path: str, epoch_id: int) -> datetime:
    """The time (UTC) at which this batch was first tried: later tries get the same, whatever day they run on.

    It is kept in ``<path>/_clocks``, for the latest hundred batches; Spark repeats only the last one.
    """
    storage = Storage(spark, f"{path}/_clocks")
    name = f"{epoch_id:012d}"
    if not storage.exists(name):
        storage.create(name, datetime.now(timezone.utc).replace(tzinfo=None).isoformat())
        for old in storage.files()[:-100]:
            storage.delete(old.name)
    return datetime.fromisoformat(storage.text(name))


def publish(df: DataFrame, sink: str, key: str = "MMSI", **options: str) -> None:
    """Write rows as keyed JSON, e.g. ``publish(df, "kafka", topic=..., **{"kafka.bootstrap.servers": ...})``."""
    to_keyed_json(df, key).write.format(sink).mode("append").options(**options).save()


def materialize(
    df: DataFrame, path: str, partition_by: str, sort_by: Sequence[str] = (), storage: Storage | None = None,
    keep: Callable[[str], bool] | None = None,
) -> None:
    """Full refresh of a table partitioned by day and sorted for row-group skipping.

    The new rows replace all old ones, or with ``keep`` those of their own days and of the day folders it refuses, by
    one commit (see ``snapshots``), so readers always find a whole table and the frame may read the table itself. The rebalance hint lets adaptive execution split a day that is far larger than
    the others and merge tiny ones.
    """
    storage = storage or Storage(df.sparkSession, path)
    old = [] if keep else [f.name for f in snapshots.outside(storage, snapshots.newest(storage))]

    def write(folder: str) -> None:
        spread = df.hint("rebalance", partition_by)
        spread.sortWithinPartitions(partition_by, *sort_by).write.partitionBy(partition_by).parquet(folder)

    snapshots.change(storage, write, df.schema, keep or (lambda _: False), old)
