"""Readers over stored layers, layer views, and the freshness gate."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline import schemas
from wakeline.sources import snapshots
from wakeline.sources.storage import Storage

#: Folder levels below a day that say who wrote a file and mean nothing once files are merged.
WRITERS = ("batch", snapshots.VERSION)


def read_layer(spark: SparkSession, path: str, fields: schemas.Fields | None = None) -> DataFrame:
    """A table of day folders, whether or not some of its days were compacted. With ``fields`` the declared schema is
    used and no file is opened to infer one."""
    return snapshots.read(spark, path, schemas.ddl(fields) if fields else None)


def read_files(spark: SparkSession, paths: Sequence[str], base: str | None = None) -> DataFrame:
    """Exactly these files, their schemas merged. Folders between ``base`` and a file that say ``name=value`` are
    columns."""
    reader = spark.read.option("mergeSchema", "true")
    return (reader if base is None else reader.option("basePath", base)).parquet(*paths)


def register_layers(spark: SparkSession, root: str) -> list[str]:
    """Views over ``root/<layer>/<table>`` with declared columns plus partition columns."""
    for view, (columns, partitions) in schemas.LAYERS.items():
        layer, table = view.split("_", 1)
        read_layer(spark, f"{root}/{layer}/{table}", columns + partitions).createOrReplaceTempView(view)
    return list(schemas.LAYERS)


def register_gold(spark: SparkSession, root: str, names: Sequence[str]) -> list[str]:
    """Views over those gold tables that some refresh has made."""
    found = [name for name in names if snapshots.exists(spark, f"{root}/gold/{name}")]
    for name in found:
        snapshots.read(spark, f"{root}/gold/{name}").createOrReplaceTempView(name)
    return found


def newest_day_problems(spark: SparkSession, path: str, declared: schemas.Fields) -> list[str]:
    """How the newest day of a stored layer differs from its declared columns; one day's files are looked at."""
    days = snapshots.marks(Storage(spark, path))
    if not days:
        return []
    return check_schema(snapshots.read(spark, path, days=[max(days)]).drop(*WRITERS), declared)


def is_fresh(spark: SparkSession, path: str, hours: float = 2, as_of: datetime | None = None) -> bool:
    """True when some data file under ``path`` changed within ``hours`` of ``as_of`` (UTC).

    Only file listings are used: no file content is read.
    """
    now = as_of or datetime.now(timezone.utc)
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "[!_.]*.parquet")
        .option("recursiveFileLookup", "true")
        .option("modifiedAfter", (now - timedelta(hours=hours)).strftime("%Y-%m-%dT%H:%M:%S"))
        .load(path)
    )
    return not files.select("path").limit(1).isEmpty()


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls per column (count, percent at one decimal) in one scan."""
    totals = df.agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)]
    )
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("nulls")) for i, c in enumerate(columns)])
    return totals.select("total", F.inline(rows)).select(
        "column", "total", "nulls",
        F.round(F.try_divide(F.col("nulls") * 100.0, F.col("total")), 1).alias("percent"),
    )


def duplicate_audit(df: DataFrame, keys: Sequence[str] = ("mmsi", "event_timestamp")) -> DataFrame:
    """Rows, distinct keys, surplus rows and keys held more than once. Copies are combined before the shuffle."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"),
        F.count_if(F.col("n") > 1).alias("duplicated_keys"),
    )


def duplicate_batches(
    df: DataFrame, keys: Sequence[str] = ("mmsi", "event_timestamp"), batch: str = "_bronze_batch_id",
    processed: str = "processing_timestamp",
) -> DataFrame:
    """Every batch holding a row whose key occurs more than once, with its rows and earliest processing time.

    Rows shrink to one per (key, batch) first, so a key with very many copies never meets itself in a join.
    """
    from pyspark.sql import Window

    per_batch = df.groupBy(*keys, batch).agg(F.count(F.lit(1)).alias("n"), F.min(processed).alias("at"))
    copies = F.sum("n").over(Window.partitionBy(*keys))
    return (
        per_batch.withColumn("copies", copies).filter(F.col("copies") > 1)
        .groupBy(batch)
        .agg(F.sum("n").alias("rows_in_duplicated_groups"), F.min("at").alias("processed_at"))
        .orderBy(F.desc("rows_in_duplicated_groups"), batch)
    )


def check_schema(df: DataFrame, declared: schemas.Fields) -> list[str]:
    """Differences between a frame and the declared columns; empty when they agree."""
    actual = dict(df.dtypes)
    wanted = dict(declared)
    problems = [f"missing column {c}" for c in wanted if c not in actual]
    problems += [f"undeclared column {c}" for c in actual if c not in wanted]
    problems += [f"{c} is {actual[c]}, declared {t}" for c, t in wanted.items() if c in actual and actual[c] != t]
    return problems
