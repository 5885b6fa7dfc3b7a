"""Micro-batch jobs: raw -> bronze archive and topic, bronze -> silver."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wakeline import schemas
from wakeline.operators.sequence import ROWS_PER_WINDOW, WHOLE_KEYS
from wakeline.plans.bronze import bronze_metadata, bronze_positions, metadata_faults, position_faults
from wakeline.plans.silver import silver_metadata, silver_positions
from wakeline.sources import sinks

TRIGGER = "30 seconds"
#: How late a copy of a message may come and still be known as one.
COPY_DELAY = "1 hour"
BatchFn = Callable[[DataFrame, int], None]
Publish = Callable[[DataFrame], None]
REASONS = ("invalid_json", "missing_mmsi", "invalid_position", "invalid_time")


def batch_name(epoch_id: int) -> str:
    """Same name when a batch is processed again after a failure."""
    return f"epoch-{epoch_id:010d}"


def once_each(
    stream: DataFrame, key: str = "MMSI", time: str = "time_utc", delay: str = COPY_DELAY
) -> DataFrame:
    """One row of each (vessel, event time), also when its copies come in different micro-batches.

    The watermark follows the newest event time by ``delay``: rows older than that are dropped as late, and the state
    forgets a key when no copy of it can be told from a late row any more.
    """
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key, time])


def audit(
    spark: SparkSession, path: str, layer: str, epoch_id: int, seen: dict[str, int], written: int, copies: bool,
    started: float,
) -> None:
    """One row about a finished micro-batch; a repeated batch replaces its row.

    What was read is written, of another kind of message, a copy (if all that the step drops are copies), or rejected,
    by reason. ``seen`` and ``written`` were observed while the batch was written.
    """
    others = seen.get("rows_other", 0)
    dropped = seen["rows_read"] - written - others
    row = (
        layer, epoch_id, batch_name(epoch_id), seen["rows_read"], written, 0 if copies else dropped, others,
        dropped if copies else 0, *[seen.get(reason, 0) for reason in REASONS], int((time.monotonic() - started) * 1000),
    )
    # A frame made from Python rows would start a Python worker for this one.
    cells = [F.lit(value).cast(kind).alias(name) for value, (name, kind) in zip(row, schemas.AUDIT[:-1], strict=True)]
    (
        spark.range(0, 1, 1, 1).select(*cells, F.current_timestamp().alias("finished_at"))
        .write.mode("overwrite").parquet(f"{path}/layer_epoch={layer}-{epoch_id}")
    )


def observed(observation: Observation, rows: DataFrame, counts: Sequence[Column]) -> dict[str, int]:
    """What ``observation`` saw, or ``counts`` taken from ``rows`` in a pass of their own.

    If no row is left to write, adaptive execution cuts the steps before out of the plan, and what they observed is lost.
    """
    try:
        seen = observation.get
    except Py4JJavaError:  # the lost row has no schema to be read by
        seen = {}
    return seen or rows.agg(*counts).first().asDict()


def _fan_out(
    transform: Callable[..., DataFrame], layer: str, archive: str, partition_by: list[str],
    publish: Publish | None, audit_path: str | None, by_clock: str | None = None, kind: str | None = None,
    faults: dict[str, Column] | None = None, read_twice: bool = False, ranges_by: Sequence[str] = (),
) -> BatchFn:
    """With ``by_clock``, a column that holds the time of the first try, the rows' day comes from it too. ``kind`` is
    the message type that the step takes from a mixed feed, ``faults`` tells why such messages are rejected.

    What is read and what is written is counted by observations in the pass that writes the archive; a batch that leaves
    nothing to write may be counted in another pass. With ``read_twice`` the batch is persisted and its rows are counted
    first; ``transform`` takes their number as a third argument.
    """

    def run(batch: DataFrame, epoch_id: int) -> None:
        started, spark, known = time.monotonic(), batch.sparkSession, ()
        if read_twice:
            batch = batch.persist()
            known = (batch.count(),)
            if known == (0,):  # a batch that only moves the watermark
                batch.unpersist()
                return
        read, done = Observation(), Observation()
        counts = [F.count(F.lit(1)).alias("rows_read")]
        if kind is not None:
            counts.append(F.count_if(F.col("MessageType") != kind).alias("rows_other"))
        counts += [F.count_if(test).alias(reason) for reason, test in (faults or {}).items()]
        rows = transform(batch.observe(read, *counts), batch_name(epoch_id), *known)
        if by_clock is not None:
            clock = F.lit(sinks.first_clock(spark, archive, epoch_id).isoformat(sep=" ")).cast("timestamp")
            rows = rows.withColumns({by_clock: clock, "partition_date": F.to_date(clock)})
        written = F.count(F.lit(1)).alias("rows_written")
        rows = rows.observe(done, written)
        if publish is not None:
            rows = rows.persist()  # both sinks get the very same rows and clock stamps
        try:
            # Taking a sample runs the plan: only persisted rows are observed once.
            sinks.write_idempotent(rows, archive, epoch_id, partition_by, ranges_by=ranges_by if publish is not None else ())
            if publish is not None:
                publish(rows)
            if audit_path is not None:
                copies = kind is None and by_clock is None
                seen, out = observed(read, batch, counts), observed(done, rows, [written])
                audit(spark, audit_path, layer, epoch_id, seen, out["rows_written"], copies, started)
        finally:
            rows.unpersist()
            batch.unpersist()

    return run


def bronze_batch(archive: str, publish: Publish | None = None, audit_path: str | None = None, **lineage) -> BatchFn:
    """Position messages: validate once, write the archive and publish the very same (persisted) rows."""
    lineage.setdefault("source_file", archive)
    return _fan_out(
        lambda batch, name: bronze_positions(batch, name, **lineage), "bronze_positions", archive,
        ["partition_date", "partition_hour"], publish, audit_path, kind="PositionReport", faults=position_faults(),
        ranges_by=["time_utc", "MMSI"],
    )


def bronze_metadata_batch(archive: str, publish: Publish | None = None, audit_path: str | None = None, **lineage) -> BatchFn:
    """Static messages carry no event time: their day is that of the batch's first try, also when it is replayed."""
    return _fan_out(
        lambda batch, name: bronze_metadata(batch, name, **lineage), "bronze_metadata", archive,
        ["partition_date"], publish, audit_path, by_clock="ingestion_timestamp", kind="ShipStaticData",
        faults=metadata_faults(),
    )


def silver_batch(table: str, audit_path: str | None = None) -> BatchFn:
    """Bronze rows of one micro-batch -> silver: de-duplicated and compared within the batch."""

    def transform(batch: DataFrame, name: str, count: int) -> DataFrame:
        # No vessel has more rows than the batch: only a large one is counted by vessel.
        rows = silver_positions(batch, scope="batch", layout=WHOLE_KEYS if count <= ROWS_PER_WINDOW else None)
        return rows.withColumns({
            "_silver_batch_id": F.lit(name), "partition_date": F.to_date("event_timestamp"),
        })

    return _fan_out(transform, "silver_positions", table, ["partition_date"], None, audit_path, read_twice=True)


def silver_metadata_batch(table: str, audit_path: str | None = None) -> BatchFn:
    def transform(batch: DataFrame, name: str) -> DataFrame:
        return silver_metadata(batch).withColumn("_silver_batch_id", F.lit(name))

    return _fan_out(transform, "silver_metadata", table, ["partition_date"], None, audit_path, by_clock="processing_timestamp")


def start(
    stream: DataFrame, batch_fn: BatchFn, checkpoint: str, name: str | None = None, trigger: dict | None = None
) -> StreamingQuery:
    """Run ``batch_fn`` on every micro-batch: every 30 seconds, or as ``trigger`` says (``availableNow=True``)."""
    writer = stream.writeStream.foreachBatch(batch_fn).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**(trigger or {"processingTime": TRIGGER})).start()
