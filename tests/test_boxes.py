"""Points in many boxes against a plain search."""

import random

import pytest
from pyspark.sql import functions as F

from wakeline import refdata as ref
from wakeline.functions import geo
from wakeline.operators.boxes import box_index, in_first_box

BOX = "south double, north double, west double, east double, rank int, name string"
POINT = "id int, latitude double, longitude double"


def some(seed=3):
    rng = random.Random(seed)
    boxes = []
    for i in range(400):
        lat, lon, half = rng.uniform(-89, 89), rng.uniform(-179, 179), rng.choice([0.01, 0.4, 3.0, 20.0])
        boxes.append((lat - half, lat + half, lon - half, lon + half, i if i % 5 else None, f"b{i}"))
    boxes += [(None, 1.0, 0.0, 1.0, -1, "no bound"), (5.0, 4.0, 0.0, 9.0, -2, "upside down"), (10.0, 10.0, 20.0, 20.0, -3, "a point")]
    points = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(600)]
    points += [(i + 1000, b[1], b[2]) for i, b in enumerate(boxes[:100])]  # corners belong to the box
    return boxes, points + [(5000, None, 1.0), (5001, 1.0, None), (5002, float("nan"), 1.0), (5003, 10.0, 20.0), (5003, 10.0, 20.0)]


def brute(boxes, points):
    out = []
    for key, lat, lon in points:
        known = lat is not None and lon is not None
        hits = [b for b in boxes if known and b[0] is not None and b[0] <= lat <= b[1] and b[2] <= lon <= b[3]]
        best = min(hits, key=lambda b: (b[4] is not None, b[4] or 0, *b[:4], b[5]), default=None)
        out.append((key, best[5] if best else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("cell", [1.0, 7.5, 0.5])
@pytest.mark.parametrize("max_rows", [1, 10_000_000])
def test_first_box(spark, cell, max_rows):
    boxes, points = some()
    got = in_first_box(spark.createDataFrame(points, POINT), spark.createDataFrame(boxes, BOX), ["name"], cell=cell, max_rows=max_rows)
    assert got.columns == ["id", "latitude", "longitude", "name"]
    assert sorted(((r["id"], r["name"]) for r in got.collect()), key=repr) == brute(boxes, points)


def test_the_ports_by_index_and_by_case(spark):
    """The fixed port table as rows: the later entry wins an overlap, so its rank comes first."""
    boxes = spark.createDataFrame(
        [(a - h, a + h, b - h, b + h, -i, i) for i, (a, b, h, _, _) in enumerate(ref.PORT_BOXES, start=1)],
        BOX.replace("name string", "number int"))
    rng = random.Random(8)
    points = spark.createDataFrame(
        [(i, p[0] + rng.uniform(-2, 2) * p[2], p[1] + rng.uniform(-2, 2) * p[2]) for i, p in enumerate(ref.PORT_BOXES * 40)], POINT)
    both = in_first_box(points.withColumn("by_case", geo.port_number()), boxes, ["number"])
    assert both.filter(~F.col("number").eqNullSafe(F.col("by_case"))).count() == 0
    assert both.filter(F.col("number").isNotNull()).count() > 100


def test_plan_is_one_join_on_the_cell(spark):
    boxes, points = some()
    df = in_first_box(spark.createDataFrame(points, POINT), spark.createDataFrame(boxes, BOX), ["name"], max_rows=1)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and plan.count("Join") == 1


def test_no_boxes_and_no_points(spark):
    boxes, points = some()
    no_boxes = in_first_box(spark.createDataFrame(points, POINT), spark.createDataFrame([], BOX), ["name"])
    assert {r["name"] for r in no_boxes.collect()} == {None} and no_boxes.count() == len(points)
    assert in_first_box(spark.createDataFrame([], POINT), spark.createDataFrame(boxes, BOX), ["name"]).count() == 0
    assert box_index(spark.createDataFrame(boxes, BOX), ["name"]).groupBy("_cell").count().filter("count > 1").count() == 0


def test_cells_hold_no_box_that_comes_after_a_covering_one(spark):
    """A thousand boxes over the same cells: one of them covers each cell, so the index stays as large as the cells."""
    boxes = [(0.0 - i, 4.0 + i, 0.0 - i, 4.0 + i, 2000 - i, f"b{i}") for i in range(3)]
    boxes += [(0.5, 3.5, 0.5, 3.5, 5000 + i, f"late{i}") for i in range(1000)] + [(1.2, 1.4, 1.2, 1.4, 7, "early")]
    points = [(i, i % 7 - 1.5, i % 5 - 0.5) for i in range(35)] + [(99, 1.3, 1.3), (100, 1.2, 1.4)]
    index = box_index(spark.createDataFrame(boxes, BOX), ["name"])
    assert index.agg(F.max(F.size("_boxes"))).first()[0] <= 4
    got = in_first_box(spark.createDataFrame(points, POINT), spark.createDataFrame(boxes, BOX), ["name"])
    assert sorted(((r["id"], r["name"]) for r in got.collect()), key=repr) == brute(boxes, points)


def test_a_lookup_past_the_limit_is_never_broadcast_by_estimate(spark, tmp_path):
    """Boxes from a small file, which Spark takes for small after every explode."""
    boxes, points = some()
    spark.createDataFrame(boxes, BOX).coalesce(1).write.parquet(str(tmp_path / "boxes"))
    many = spark.read.parquet(str(tmp_path / "boxes"))
    df = in_first_box(spark.createDataFrame(points, POINT), many, ["name"], max_rows=1)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") >= 1 and "_boxes" not in "".join(
        line for line in plan.splitlines() if "BroadcastExchange" in line)
