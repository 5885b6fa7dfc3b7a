"""Points in boxes, for any number of boxes: an index of grid cells instead of one CASE chain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.operators.joins import BROADCAST_ROWS, fits_broadcast, left_lookup
from wakeline.session import written

#: Side of a cell in degrees, and the factor that puts two cell numbers into one.
CELL_DEGREES, STRIDE = 1.0, 1_000_000
#: What a box must reach beyond a cell, in sides, to count as covering it: more than a rounded quotient is off.
MARGIN = 1e-6


def _cell(value: Column, side: float) -> Column:
    return F.floor(value / F.lit(side))


def box_index(boxes: DataFrame, attributes: Sequence[str], rank: str = "rank", cell: float = CELL_DEGREES) -> DataFrame:
    """(_cell, _boxes): for each grid cell the boxes that reach into it, the lowest rank first.

    ``boxes`` has south, north, west, east, the rank and the attributes. A box is a row for every cell it touches, so
    the cell should not be much smaller than most boxes. Boxes do not wrap at the antimeridian; one whose bounds are
    null, or that ends before it begins, holds no point. A box that ranks after one which covers the whole cell is the
    first for no point there and is left out of it, so cells do not fill up with the boxes of a dense table.
    """
    bounds = ["south", "north", "west", "east"]

    def cells(low: str, high: str) -> Column:
        return F.explode(F.sequence(_cell(F.col(low), cell), _cell(F.col(high), cell)))

    usable = boxes.filter((F.col("south") <= F.col("north")) & (F.col("west") <= F.col("east"))).select(
        F.col(rank).alias("_rank"), *bounds, *attributes)
    touched = usable.withColumn("_row", cells("south", "north")).withColumn("_column", cells("west", "east")).withColumn(
        "_cell", F.col("_row") * STRIDE + F.col("_column"))

    def within(low: str, at: str, high: str) -> Column:
        return (F.col(low) <= (F.col(at) - MARGIN) * cell) & (F.col(high) >= (F.col(at) + (1 + MARGIN)) * cell)

    # Combined on the map side: a task sends a row for each covered cell at most. Null ranks come first.
    covered = touched.filter(within("south", "_row", "north") & within("west", "_column", "east")).groupBy(
        F.col("_cell").alias("_covered")).agg(F.min("_rank").alias("_first"), F.bool_or(F.col("_rank").isNull()).alias("_null"))
    stored = written(covered, "covered")
    if fits_broadcast(stored):
        stored = F.broadcast(stored)
    after = (F.col("_covered") == F.col("_cell")) & F.col("_rank").isNotNull() & (F.col("_null") | (F.col("_rank") > F.col("_first")))
    return touched.join(stored, after, "left_anti").groupBy("_cell").agg(
        F.array_sort(F.collect_list(F.struct("_rank", *bounds, *attributes))).alias("_boxes"))


def in_first_box(
    points: DataFrame, boxes: DataFrame, attributes: Sequence[str], rank: str = "rank", lat: str = "latitude",
    lon: str = "longitude", salt_from: str | None = None, cell: float = CELL_DEGREES, max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``points`` with the attributes of the box of the lowest rank that holds them (bounds included), null outside all.

    An equi-join on the grid cell finds the few boxes around a point, and the exact test runs inside the row: a point
    stays one row and nothing is grouped. The index is written to the shared folder and broadcast if its boxes, counted
    once for each cell, are few enough; else cells are joined by shuffle, a busy cell's points spread by a hash of
    ``salt_from`` (by default of both coordinates).
    """
    index = written(box_index(boxes, attributes, rank, cell), "boxes")
    where = _cell(F.col(lat), cell) * STRIDE + _cell(F.col(lon), cell)
    salt = F.struct(lat, lon) if salt_from is None else F.col(salt_from)
    # Boxes counted for each cell bound what a broadcast holds, however many lie in one cell.
    entries = index.select(F.explode("_boxes").alias("_box"))
    met = left_lookup(points.withColumn("_cell", where), index, "_cell", salt, entries, max_rows)
    inside = F.filter("_boxes", lambda b: F.col(lat).between(b["south"], b["north"]) & F.col(lon).between(b["west"], b["east"]))
    return met.withColumn("_box", F.get(inside, F.lit(0))).withColumns(
        {name: F.col(f"_box.{name}") for name in attributes}).drop("_cell", "_boxes", "_box")
