"""Session settings shared by batch jobs, streams and tests."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "wakeline", master: str | None = None, **conf: str) -> SparkSession:
    """A UTC session with adaptive execution and skew-join splitting on."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.parquet.filterPushdown", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return use_utc(builder.getOrCreate())


def use_utc(spark: SparkSession) -> SparkSession:
    """Dates, hours and partition keys are UTC everywhere, whatever zone the JVM runs in."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@cache
def _local_scratch(app_id: str) -> str:
    return tempfile.mkdtemp(prefix="wakeline-")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    A single-machine session without the setting gets its own folder; a cluster session must name one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_scratch(spark.sparkContext.applicationId)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new folder in the shared directory and read back: what is read twice is computed once, and a
    lost executor costs no earlier step."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
