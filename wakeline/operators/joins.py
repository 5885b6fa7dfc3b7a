"""Left join to a keyed lookup that may or may not be small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.operators.sequence import ROWS_PER_WINDOW, TrackLayout
from wakeline.session import written

BROADCAST_ROWS = 500_000
SALTS = 32


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """A count that every task makes of its own rows: none of them travel."""
    return df.count() <= max_rows


def hot_keys(df: DataFrame, key: str, share: int, most: int = ROWS_PER_WINDOW) -> list:
    """Keys that hold more than one row in ``share``, or more than ``most`` rows: few by construction."""
    counts = written(df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("rows")), "keys")
    rows = counts.agg(F.sum("rows")).first()[0] or 0
    return [row.key for row in counts.filter((F.col("rows") > min(rows // share, most)) & F.col("key").isNotNull()).collect()]


def left_lookup(
    left: DataFrame,
    right: DataFrame,
    key: str,
    salt_from: Column,
    keys: DataFrame | None = None,
    max_rows: int = BROADCAST_ROWS,
    salts: int = SALTS,
    layout: TrackLayout | None = None,
) -> DataFrame:
    """``left ⟕ right`` on ``key``, ``right`` holding one row per key.

    The lookup is broadcast only after its row count was checked (on ``keys``, a cheaper frame with one row for
    every row of ``right``, when given). Past the limit the join shuffles, also if Spark takes the lookup for small: its
    estimate knows nothing of rows that were exploded. Hot keys of ``left`` are spread over ``salts`` parts (with their
    lookup rows, and no others, repeated for each), so that none of them is one task; where there are none, a ``left``
    that lies by key already is not shuffled again. The hot keys are those of ``layout``, made for ``key``; without one
    they are counted.
    """
    if fits_broadcast(right.select(key) if keys is None else keys, max_rows):
        return left.join(F.broadcast(right), key, "left")
    if layout is None:
        hot = hot_keys(left, key, salts)
    else:
        hot = [] if layout.whole_keys else [row[0] for row in layout.hot.collect() if row[0] is not None]
    if not hot:
        return left.join(right.hint("merge"), key, "left")
    is_hot = F.col(key).isin(hot)
    spread = F.pmod(F.xxhash64(salt_from), F.lit(salts)).cast("int")
    # Null meets nothing, so its rows may lie anywhere.
    salted_left = left.withColumn("_salt", F.when(is_hot | F.col(key).isNull(), spread).otherwise(0))
    parts = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_right = right.withColumn("_salt", F.explode(parts))
    return salted_left.join(salted_right.hint("merge"), [key, "_salt"], "left").drop("_salt")
