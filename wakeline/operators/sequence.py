"""Previous-row values along each vessel's track, without putting a whole hot vessel into one task.

A plain ``lag`` over ``partitionBy(vessel)`` sorts everything a vessel ever sent in a single task, which breaks as
soon as one MMSI (a shared default number, say) holds a large share of the rows. So the rows per key are counted
first, from one column. Keys that fit one window take it: one shuffle, one sort. The rows of the other keys are
range-partitioned by key, time, ties and a running number, so any of them can be cut anywhere, also inside one
instant; each range passes its rows on with the row before, and what a range begins with takes its predecessor from
the last row of the range before it, a table of two rows for each range.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline.session import written

# The function that walks a range runs in Python workers that may not have this package: it travels by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
ROWS_PER_WINDOW = 2_000_000
#: Beside the rows: the running number, the range, and whether a row is the first (1) or the last (2) of its range.
PLACE, PART, EDGE = "_place", "_part", "_edge"


@dataclass(frozen=True)
class TrackLayout:
    """How tracks are windowed: all keys whole, or those in ``hot`` (one column, ``_hot_key``) in so many ranges.
    ``rows`` is how many rows were counted."""

    whole_keys: bool
    hot: DataFrame | None = None
    ranges: int = 0
    rows: int = 0


WHOLE_KEYS = TrackLayout(True)


def track_layout(
    df: DataFrame, key: str, time: str, rows_per_window: int = ROWS_PER_WINDOW, ranges: int | None = None
) -> TrackLayout:
    """Count the rows per key (combined before the shuffle) and choose. An upper bound will do: count the stored
    rows before filters and joins, and pass the layout on to every model built on them.

    A range takes half of ``rows_per_window`` on average, as its bounds come from a sample, unless ``ranges`` says how
    many there are."""
    per_key = df.groupBy(F.col(key).alias("_hot_key")).agg(F.count(F.lit(1)).alias("_rows"))
    hot = F.col("_rows") > rows_per_window
    every, rows = per_key.agg(F.sum("_rows"), F.sum(F.when(hot, F.col("_rows")))).first()
    if not rows:
        return TrackLayout(True, rows=every or 0)
    return TrackLayout(False, per_key.filter(hot).select("_hot_key"), ranges or -(-2 * rows // rows_per_window), every)


Names = dict[str, str]


def _walk(track: list[str], before: Names, latest: Names) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Add the values of the row before and the latest values that are not null, both null where the track begins, and
    mark the first and last row of the range."""
    needed = list(dict.fromkeys([*track, *before.values()]))

    def shifted(batch: pa.RecordBatch, last: pa.RecordBatch | None) -> dict[str, pa.Array]:
        out = {}
        for name in needed:
            here = batch.column(name)
            first = pa.nulls(1, here.type) if last is None else last.column(name)
            out[name] = pa.concat_arrays([first, here.slice(0, len(here) - 1)])
        return out

    def filled(values: pa.Array, same: np.ndarray, open_value: pa.Array) -> pa.Array:
        """``open_value`` (one element) is what the track that the batch begins in has had so far."""
        at = np.arange(len(values))
        begin = np.maximum.accumulate(np.where(same, -1, at))
        newest = np.maximum.accumulate(np.where(values.is_valid().to_numpy(zero_copy_only=False), at, -1))
        source = np.where(newest >= np.maximum(begin, 0), newest, np.where(begin < 0, len(values), -1))
        return pa.concat_arrays([values, open_value]).take(pa.array(source, mask=source < 0))

    def marked(batch: pa.RecordBatch, last: pa.RecordBatch | None, part: int, ends: bool) -> pa.RecordBatch:
        earlier = shifted(batch, last)
        same = np.ones(len(batch), bool)
        for name in track:
            here, there = batch.column(name), earlier[name]
            both_null = pc.and_(pc.is_null(here), pc.is_null(there))
            same &= pc.or_(pc.fill_null(pc.equal(here, there), False), both_null).to_numpy(zero_copy_only=False)
        edge = np.zeros(len(batch), np.int32)
        if last is None:
            same[0], edge[0] = False, 1
        edge[-1] += 2 * ends
        shift = [pc.if_else(pa.array(same), earlier[c], pa.scalar(None, earlier[c].type)) for c in before.values()]
        fill = [filled(batch.column(old), same, pa.nulls(1, batch.column(old).type) if last is None else last.column(new))
                for new, old in latest.items()]
        return pa.RecordBatch.from_arrays(
            [*batch.columns, *shift, *fill, pa.array(np.full(len(batch), part, np.int32)), pa.array(edge)],
            names=[*batch.schema.names, *before, *latest, PART, EDGE])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, last = TaskContext.get().partitionId(), None, None
        for batch in batches:
            if not len(batch):
                continue
            if held is not None:
                done = marked(held, last, part, False)
                last = done.slice(len(done) - 1)
                yield done
            held = batch
        if held is not None:
            yield marked(held, last, part, True)

    return walk


def in_ranges(
    rows: DataFrame, track: list[str], order: list[str], ranges: int, before: Names | None = None, latest: Names | None = None
) -> DataFrame:
    """``rows`` with the columns of the row before, and the latest values, of the same track in the same range.

    Written to the shared folder: both readers of the ranges must see the same bounds, whatever is computed again.
    """
    before, latest = before or {}, latest or {}
    sort = [*track, *order, PLACE]
    fields = [T.StructField(new, rows.schema[old].dataType) for new, old in (before | latest).items()]
    marks = [T.StructField(PART, T.IntegerType()), T.StructField(EDGE, T.IntegerType())]
    numbered = rows.withColumn(PLACE, F.monotonically_increasing_id())
    schema = T.StructType([*numbered.schema.fields, *fields, *marks])
    sorted_rows = numbered.repartitionByRange(ranges, *sort).sortWithinPartitions(*sort)
    return written(sorted_rows.mapInArrow(_walk(track, before, latest), schema), "tracks")


def stitched(ranged: DataFrame, columns: Names, track: list[str]) -> DataFrame:
    """Give the first row of each range its predecessor, the last row of the range before it."""
    firsts = F.col(EDGE).bitwiseAND(1) == 1
    edges = ranged.filter(F.col(EDGE) > 0)
    # At most two rows for each range come together here.
    along = Window.orderBy(PART, EDGE)
    earlier = F.lag(F.struct(*dict.fromkeys([*track, *columns.values()]))).over(along)
    same = F.col("_earlier").isNotNull()
    for name in track:
        same = same & F.col(f"_earlier.{name}").eqNullSafe(F.col(name))
    opened = edges.withColumn("_earlier", earlier).filter(firsts).withColumns({
        new: F.when(same, F.col(f"_earlier.{old}")) for new, old in columns.items()
    }).drop("_earlier")
    return ranged.filter(~firsts).unionByName(opened).drop(PLACE, PART, EDGE)


def carried(ranged: DataFrame, columns: Names, track: list[str]) -> DataFrame:
    """Give the rows at the beginning of each range the latest values of the ranges before it."""
    of_track = F.struct(*track).alias("_track")
    is_head, is_tail = F.col(EDGE).bitwiseAND(1) == 1, F.col(EDGE).bitwiseAND(2) == 2
    values = F.struct(*columns)
    heads = ranged.filter(is_head).select(PART, of_track, F.lit(0).alias("_tail"), F.when(F.lit(False), values).alias("_had"))
    tails = ranged.filter(is_tail).select(PART, of_track, F.lit(1).alias("_tail"), values.alias("_had"))
    along = Window.partitionBy("_track").orderBy(PART, "_tail").rowsBetween(Window.unboundedPreceding, -1)
    carry = heads.unionByName(tails).withColumns({
        f"_open_{c}": F.last(F.col(f"_had.{c}"), ignorenulls=True).over(along) for c in columns
    }).filter("_tail = 0").select(F.col(PART).alias("_of"), "_track", *[f"_open_{c}" for c in columns])
    # One row for each range: as many as there are tasks.
    met = ranged.join(F.broadcast(carry), (F.col(PART) == F.col("_of")) & F.struct(*track).eqNullSafe(F.col("_track")), "left")
    return met.withColumns({c: F.coalesce(c, f"_open_{c}") for c in columns}).drop(
        "_of", "_track", *[f"_open_{c}" for c in columns], PLACE, PART, EDGE)


def with_latest(
    df: DataFrame, columns: Names, key: str = "mmsi", time: str = "event_timestamp", ties: tuple[str, ...] = (),
    layout: TrackLayout | None = None,
) -> DataFrame:
    """Add ``new_name -> latest value of column that is not null``, on the key's track up to and with the row itself."""
    layout = layout or track_layout(df, key, time)

    def whole(rows: DataFrame) -> DataFrame:
        window = Window.partitionBy(key).orderBy(time, *ties).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return rows.withColumns({new: F.last(old, ignorenulls=True).over(window) for new, old in columns.items()})

    if layout.whole_keys:
        return whole(df)
    is_hot = F.col(key).eqNullSafe(F.col("_hot_key"))
    ranged = in_ranges(df.join(layout.hot, is_hot, "left_semi"), [key], [time, *ties], layout.ranges, latest=columns)
    return whole(df.join(layout.hot, is_hot, "left_anti")).unionByName(carried(ranged, columns, [key]))


def with_previous(
    df: DataFrame,
    columns: dict[str, str],
    key: str = "mmsi",
    time: str = "event_timestamp",
    ties: tuple[str, ...] = (),
    per_day: str | None = None,
    layout: TrackLayout | None = None,
) -> DataFrame:
    """Add ``new_name -> value of column in the key's previous row`` for every entry of ``columns``.

    ``per_day`` names the day column at whose change the track starts anew. Without a ``layout`` the frame is counted
    first. Rows that agree in key, time and ties come in any order; equal rows are rows each.
    """
    layout = layout or track_layout(df, key, time)
    track = [key, per_day] if per_day else [key]
    earlier_row = F.struct(*[F.col(source).alias(name) for name, source in columns.items()])

    def whole(rows: DataFrame) -> DataFrame:
        window = Window.partitionBy(*track).orderBy(time, *ties)
        previous = rows.withColumn("_prev", F.lag(earlier_row).over(window))
        return previous.withColumns({name: F.col(f"_prev.{name}") for name in columns}).drop("_prev")

    if layout.whole_keys:
        return whole(df)
    is_hot = F.col(key).eqNullSafe(F.col("_hot_key"))
    ranged = in_ranges(df.join(layout.hot, is_hot, "left_semi"), track, [time, *ties], layout.ranges, before=columns)
    return whole(df.join(layout.hot, is_hot, "left_anti")).unionByName(stitched(ranged, columns, track))
