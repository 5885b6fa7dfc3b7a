"""Staging written once and read by every model: laid out by vessel, so that no model shuffles by vessel again."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.operators.sequence import WHOLE_KEYS, TrackLayout
from wakeline.session import shared_dir
from wakeline.sources.storage import Storage

#: Rows of one bucket on average, and the most buckets that Spark takes.
ROWS_PER_BUCKET, MOST_BUCKETS = 5_000_000, 100_000
Model = Callable[[DataFrame, TrackLayout], DataFrame]


@dataclass(frozen=True)
class Staged:
    """Rows of vessels that fit a window, in a table bucketed by vessel and sorted by time, and those of hot vessels,
    which no bucket could hold, in a plain table."""

    fit: DataFrame
    hot: DataFrame | None
    layout: TrackLayout
    names: tuple[str, ...]

    @property
    def rows(self) -> DataFrame:
        return self.fit if self.hot is None else self.fit.unionByName(self.hot)

    def each(self, model: Model) -> DataFrame:
        """A model that looks at one vessel at a time, over both kinds of vessels."""
        found = model(self.fit, WHOLE_KEYS)
        return found if self.hot is None else found.unionByName(model(self.hot, self.layout))

    def remove(self) -> None:
        spark = self.fit.sparkSession
        folder = Storage(spark, shared_dir(spark))
        for name in self.names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            folder.delete(name)


def write_staging(stg: DataFrame, layout: TrackLayout, by: str = "mmsi", time: str = "event_timestamp") -> Staged:
    """Write ``stg`` to the shared folder by the layout that its rows were counted for.

    Windows and groups by vessel, alone or with more columns, and joins of their results need no further shuffle. A
    vessel's rows lie in time order.
    """
    spark = stg.sparkSession
    buckets = int(min(MOST_BUCKETS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), layout.rows // ROWS_PER_BUCKET + 1)))
    names = [f"staging_{uuid.uuid4().hex}"]

    def save(rows: DataFrame, name: str, bucketed: bool) -> DataFrame:
        writer = rows.write.option("path", f"{shared_dir(spark)}/{name}")
        if bucketed:
            writer = writer.bucketBy(buckets, by).sortBy(by, time)
        writer.saveAsTable(name)
        return spark.table(name)

    if layout.whole_keys:
        return Staged(save(stg.repartition(buckets, by), names[0], True), None, layout, tuple(names))
    names.append(f"{names[0]}_hot")
    is_hot = F.col(by).eqNullSafe(F.col("_hot_key"))
    fit = save(stg.join(layout.hot, is_hot, "left_anti").repartition(buckets, by), names[0], True)
    hot = save(stg.join(layout.hot, is_hot, "left_semi").hint("rebalance"), names[1], False)
    return Staged(fit, hot, layout, tuple(names))
