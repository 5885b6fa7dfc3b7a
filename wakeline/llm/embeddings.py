"""Operator 8, embedding near-duplicates: collisions counted over sorted projections, then verified by cosine."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm.common import by_run, quoted, settle, spread, store, table

THRESHOLD = 0.93
#: Projections, the chance to find a pair at the threshold, and vectors compared in one piece.
PROJECTIONS, RECALL, MEMBERS = 32, 0.999, 2048
#: Width of a cell of the first projection, in distances at the threshold: further apart is a chance of 1 in 16,000.
WIDE = 4.0


def directions(dims: int) -> np.ndarray:
    """Gaussian directions: the same for every task, as they follow from the number of dimensions."""
    return np.random.default_rng(8000 + dims).standard_normal((dims, PROJECTIONS))


def distance_at(threshold: float) -> float:
    return math.sqrt(max(0.0, 2 * (1 - threshold)))


def calibrated_count(recall: float) -> int:
    """The most collisions that a pair at the threshold reaches with the recall.

    The window reaches one distance at the threshold to either side. The difference of two projections is normal with
    the distance of the vectors as its deviation, so a pair at the threshold collides with a chance of 0.683 in each
    projection, and closer pairs more often; the number of collisions is binomial.
    """
    p = math.erf(1 / math.sqrt(2))
    tail = 0.0
    for count in range(PROJECTIONS, -1, -1):
        tail += math.comb(PROJECTIONS, count) * p**count * (1 - p) ** (PROJECTIONS - count)
        if tail >= recall:
            return count
    return 0


def prepared(vectors: DataFrame, key: str, vector: str, label: str, threshold: float) -> DataFrame:
    """(id, node, label, dims, cell, unit) for each row; node is null for vectors that link with nothing."""

    @F.arrow_udf("struct<unit:array<double>,first:double>")
    def unit(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        first: dict[int, np.ndarray] = {}
        for batch in batches:
            out = []
            for x in batch.to_pylist():
                v = np.array([math.nan if e is None else e for e in x or []], np.float64)
                # Scaling by the largest component first keeps very large and very small vectors from over- and underflow.
                most = np.abs(v).max() if len(v) else 0.0
                if not np.isfinite(most) or most == 0:
                    out.append(None)
                    continue
                v = v / most
                v = v / np.linalg.norm(v)
                if len(v) not in first:
                    first[len(v)] = directions(len(v))[:, 0]
                out.append({"unit": v, "first": float(v @ first[len(v)])})
            yield pa.array(out, pa.struct([("unit", pa.list_(pa.float64())), ("first", pa.float64())]))

    x = F.col(quoted(vector))
    rows = vectors.select(F.col(quoted(key)).alias("id"), F.col(quoted(label)).alias("label"), x.alias("x"), unit(x).alias("u"))
    live = F.col("u").isNotNull() & F.col("label").isNotNull()
    width = max(WIDE * distance_at(threshold), 1e-6)
    name = F.col("label").cast("string")  # its length before it, as a text may hold what separates the components
    return rows.select(
        "id", F.when(live, F.sha1(F.concat_ws(",", F.length(name).cast("string"), name, F.col("x").cast("array<string>")))).alias("node"),
        "label", F.size("x").alias("dims"), F.floor(F.col("u.first") / width).alias("cell"), F.col("u.unit").alias("unit"))


def neighbouring(nodes: DataFrame) -> DataFrame:
    """Each node once for every pair of blocks that its own block is in.

    A label's vectors lie in cells along the first projection; a cell with many is dealt into blocks by hash. Blocks
    meet others of their cell and of the next one; vectors further apart never meet.
    """
    group = ["label", "dims"]
    sizes = nodes.groupBy(*group, "cell").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).cast("int").alias("blocks"))
    seen = nodes.join(sizes, [*group, "cell"]).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))

    def towards(step: int) -> DataFrame:
        there = sizes.select(*group, (F.col("cell") - step).alias("cell"), F.col("blocks").alias("others"))
        return seen.join(there, [*group, "cell"]).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))

    def task(left_cell, left, right_cell, right, side) -> list:
        return [left_cell.alias("c1"), left.alias("s1"), right_cell.alias("c2"), right.alias("s2"), side.alias("right")]

    cell, own, other = F.col("cell"), F.col("own"), F.col("other")
    rest = [*group, "node", "copies", "unit"]
    same = towards(0).select(*rest, *task(cell, F.least(own, other), cell, F.greatest(own, other), own > other))
    left = towards(1).select(*rest, *task(cell, own, cell + 1, other, F.lit(False)))
    right = towards(-1).select(*rest, *task(cell - 1, other, cell, own, F.lit(True)))
    return same.unionByName(left).unionByName(right)


def verified(tasks: DataFrame, threshold: float, recall: float) -> DataFrame:
    """(node, tied, links) of each pair of blocks: collisions in sorted projections, then the cosine."""
    least, reach = calibrated_count(recall), distance_at(threshold) + 1e-12

    def compare(run: pd.DataFrame) -> pd.DataFrame:
        alone = (run["c1"].iloc[0], run["s1"].iloc[0]) == (run["c2"].iloc[0], run["s2"].iloc[0])
        unit = np.stack(run["unit"].to_numpy())
        copies, side = run["copies"].to_numpy(), run["right"].to_numpy()
        left = np.arange(len(run)) if alone else np.flatnonzero(~side)
        right = np.arange(len(run)) if alone else np.flatnonzero(side)
        labels, links = np.arange(len(run)), np.zeros(len(run), np.int64)
        if len(left) and len(right):
            seen = unit @ directions(unit.shape[1])
            order = np.argsort(seen[right], axis=0, kind="stable")
            ordered = np.take_along_axis(seen[right], order, axis=0)
            begin = np.stack([np.searchsorted(ordered[:, p], seen[left, p] - reach, "left") for p in range(PROJECTIONS)])
            end = np.stack([np.searchsorted(ordered[:, p], seen[left, p] + reach, "right") for p in range(PROJECTIONS)])
            for k, i in enumerate(left):
                met = np.concatenate([order[begin[p, k]:end[p, k], p] for p in range(PROJECTIONS)])
                near = right[np.bincount(met, minlength=len(right)) >= least]
                if alone:
                    near = near[near > i]
                if len(near):
                    near = near[unit[near] @ unit[i] >= threshold]
                if len(near):
                    links[i] += copies[near].sum()
                    links[near] += copies[i]
                    spread(labels, i, near)
        told = np.flatnonzero(links > 0)
        node = run["node"].to_numpy()
        return pd.DataFrame({"node": node[told], "tied": node[labels[told]], "links": links[told]})

    return by_run(tasks, ["label", "dims", "c1", "s1", "c2", "s2"], compare, "node string, tied string, links long")


def near_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                 threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(key, n_links, component_id, kept) for each row: links between vectors of one label with at least the cosine.

    Equal vectors of a label are one node with a number of copies. Every vector is projected on many directions; in
    each, sorted, the vectors within the distance that the threshold allows collide with it. Pairs with the count of
    collisions that a pair at the threshold reaches with the recall are verified by their cosine in double precision,
    so no link lies below the threshold, and one at the threshold is found with about the recall.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows without a label, link with
    nothing. Vectors of different length never meet. component_id is the smallest key that links reach; a null key is
    larger than any other, and a row is kept if its key is the component's. Repeated rows are rows each. Other columns
    are not read. An empty table gives no rows.
    """
    told = store(prepared(vectors, key, vector, label, threshold), "vectors")
    low = F.min(F.struct(F.col("id").isNull().alias("none"), "id")).alias("low")
    nodes = store(told.where(F.col("node").isNotNull()).groupBy("node").agg(
        low, F.count(F.lit(1)).alias("copies"), *[F.first(c).alias(c) for c in ("label", "dims", "cell", "unit")]), "nodes")
    links = store(verified(neighbouring(nodes), threshold, recall), "vector-links")
    out = settle(told.select("id", "node"), nodes, links, "vector-classes")
    component = F.when(F.col("class_low").isNull(), F.col("id")).otherwise(F.col("class_low.id"))
    return out.select(F.col("id").alias(key), "n_links", component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
