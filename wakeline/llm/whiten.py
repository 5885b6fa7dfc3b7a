"""Operator 12, whitening of embeddings: components by QDWH spectral divide and conquer, then one broadcast projection."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm.common import quoted, store, table

#: Components that a row is projected on, entries per unit of a component, and what keeps the whole numbers positive.
COMPONENTS, SCALE, SHIFT = 8, 1024.0, 100_000
#: Partial sums of tasks are added in this many parts, then the parts.
PARTS = 64
EPS = np.finfo(np.float64).eps


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by the QR-based, dynamically weighted Halley iteration.

    Each step maps the singular values, which lie in [low, 1] after scaling, towards 1; the weights are the best for
    that interval, so six or seven steps do for any condition that doubles can hold.
    """
    d = len(a)
    x = a / np.linalg.norm(a)
    low = max(float(np.abs(np.linalg.inv(x)).sum(axis=0).max()) ** -1, EPS) / math.sqrt(d) if _regular(x) else EPS / d
    for _ in range(40):
        g = np.cbrt(4 * (1 - low**2) / low**4)
        h = math.sqrt(1 + g)
        wa = h + 0.5 * math.sqrt(max(8 - 4 * g + 8 * (2 - low**2) / (low**2 * h), 0.0))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.vstack([math.sqrt(wc) * x, np.eye(d)]))
        new = (wb / wc) * x + (wa - wb / wc) / math.sqrt(wc) * (q[:d] @ q[d:].T)
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x, low = new, min(1.0, low * (wa + wb * low**2) / (1 + wc * low**2))
        if moved <= (5 * EPS) ** (1 / 3) and abs(1 - low) < 10 * EPS:
            break
    return x


def _regular(x: np.ndarray) -> bool:
    try:
        return bool(np.isfinite(np.linalg.inv(x)).all())
    except np.linalg.LinAlgError:
        return False


def split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of two invariant subspaces of a: eigenvalues above and below a shift; None if all are equal.

    The mean of the eigenvalues parts them unless all are equal; the polar factor of a - shift gives the projector on
    the upper ones. A shift too near an eigenvalue leaves no clear projector: the next one lies a little further up.
    """
    d = len(a)
    mean = np.trace(a) / d
    wide = np.linalg.norm(a - mean * np.eye(d))
    if wide <= 4 * d * EPS * np.linalg.norm(a):
        return None
    best = None
    for step in range(12):
        u = polar(a - (mean + step * 0.037 * wide / d) * np.eye(d))
        p = (u + np.eye(d)) / 2
        rank = round(float(np.trace(p)))
        unclear = np.linalg.norm(p @ p - p)
        if 0 < rank < d and (best is None or unclear < best[0]):
            best = unclear, p, rank
        if best is not None and best[0] <= 1e-12 * d:
            break
    if best is None:
        return None
    _, p, rank = best
    # The longest columns first: the basis of the upper subspace comes from well-conditioned columns of the projector.
    q, left = np.zeros((d, 0)), p.copy()
    for _ in range(rank):
        column = left[:, np.argmax((left**2).sum(axis=0))]
        column = column - q @ (q.T @ column)
        q = np.column_stack([q, column / np.linalg.norm(column)])
        left = left - np.outer(q[:, -1], q[:, -1] @ left)
    upper = p @ q  # one step of subspace iteration
    full, _ = np.linalg.qr(np.column_stack([upper, np.eye(d)]))
    return full[:, :rank], full[:, rank:d]


def components(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of a symmetric matrix, by recursive spectral division."""
    v = (v + v.T) / 2

    def divide(basis: np.ndarray) -> Iterator[np.ndarray]:
        a = basis.T @ v @ basis
        parts = split((a + a.T) / 2) if basis.shape[1] > 1 else None
        if parts is None:
            yield basis
            return
        for part in parts:
            yield from divide(basis @ part)

    if not v.any():
        return np.zeros(len(v)), np.eye(len(v))
    vectors = np.column_stack(list(divide(np.eye(len(v)))))
    # What rounding left between the parts: one Gram-Schmidt pass, and the quotients as eigenvalues.
    vectors = vectors / np.linalg.norm(vectors, axis=0)
    values = np.einsum("ij,ij->j", vectors, v @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def whole_numbers(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, x): floor(1024 * entry) + 100000 of each vector that has entries, all of them finite numbers."""
    c = F.col("c")
    entries = F.transform("v", lambda e: e.cast("double"))
    rows = vectors.select(F.col(quoted(key)).alias("key"), F.col(quoted(vector)).alias("v")).select("key", entries.alias("c"))
    # Beyond 2^53 a double no longer tells whole numbers apart.
    usable = (F.size("c") > 0) & F.forall("c", lambda e: F.coalesce(F.abs(e * SCALE) < 2.0**53, F.lit(False)))
    return rows.where(c.isNotNull() & usable).select("key", F.transform(
        "c", lambda e: F.floor(e * SCALE) + F.lit(SHIFT)).alias("x"))


def blocks_of(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for batch in batches:
        if len(batch):
            yield batch.column(0), batch.column(1).flatten().to_numpy().reshape(-1, dims)


def added(rows: DataFrame, dims: int, part_of) -> np.ndarray:
    """The sum over all rows of a matrix that part_of makes of a block of whole-number vectors.

    Tasks add up their own blocks; their sums are added in PARTS parts, then at the driver: at most PARTS matrices,
    whose size comes from the dimensions, not from the rows.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = None
        for _, x in blocks_of(batches, dims):
            part = part_of(x)
            whole = part if whole is None else whole + part
        if whole is not None:
            yield pa.RecordBatch.from_arrays([
                pa.array([TaskContext.get().partitionId() % PARTS], pa.int32()),
                pa.array([whole.ravel().tolist()], pa.list_(pa.float64()))], names=["part", "sums"])

    def merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = None
        for batch in batches:
            for sums in batch.column("sums"):
                one = sums.values.to_numpy()
                whole = one if whole is None else whole + one
        yield pa.RecordBatch.from_arrays([pa.array([whole.tolist()], pa.list_(pa.float64()))], names=["sums"])

    sums = rows.select("key", "x").mapInArrow(task, "part int, sums array<double>")
    parts = sums.groupBy("part").applyInArrow(merge, "sums array<double>").collect()
    return np.sum([np.array(p.sums) for p in parts], axis=0)


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error): each vector on the largest components.

    Entries become whole numbers x = floor(1024 * entry) + 100000. Counts and sums are exact; the covariance is added
    up from centred rows, partial sums in tasks first. Polar decompositions of the shifted covariance give projectors
    on its invariant subspaces, which are divided until each is one component. The projection, a matrix of dimensions x
    ``most``, is sent to every task; identity_error is measured on the projected rows. Only matrices of the vectors'
    dimensions come to the driver.

    Vectors that are null, empty or hold null, non-finite or huge entries (1024 times the entry passes 2^53) are
    dropped; so are vectors of another length than the most frequent one (of equal frequency, the longest). Equal
    vectors and repeated rows count each, null keys too. whitened and identity_error are null where a component has no
    variance (as with one row), explained where there is none at all, deviation where it passes 64 bits. Components of
    equal variance may be any orthonormal basis. Other columns are not read. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = whole_numbers(vectors, key, vector)
    kind = dict(rows.dtypes)["key"]
    schema = (f"key {kind}, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    names = [F.col("key").alias(key), "component", "n", "deviation", "whitened", "explained", "identity_error"]
    # One row for each length of vectors comes to the driver, at most the largest length.
    most_frequent = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc("n"), F.desc("d")).first()
    if most_frequent is None:
        return spark.createDataFrame([], schema).select(*names)
    dims, n = most_frequent.d, most_frequent.n
    rows = store(rows.where(F.size("x") == dims), "whole-numbers")
    total = {r.i: int(r.s) for r in rows.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).alias("s")).collect()}
    sums = [total[i] for i in range(dims)]
    mean = np.array([s // n for s in sums], np.float64) + np.array([(s % n) / n for s in sums])

    def products(x: np.ndarray) -> np.ndarray:
        y = x - mean
        return y.T @ y

    values, axes = components(added(rows, dims, products).reshape(dims, dims) / n)
    trace, least = float(values.sum()), dims * EPS * float(values.max(initial=0.0))
    kept = min(most, dims)
    live = values[:kept] > least
    into = np.where(live, axes[:, :kept] / np.sqrt(np.where(live, values[:kept], 1.0)), 0.0)

    def spread(x: np.ndarray) -> np.ndarray:
        z = np.column_stack([(x - mean) @ into, np.ones(len(x))])
        return z.T @ z

    seen = added(rows, dims, spread).reshape(kept + 1, kept + 1) / n
    covariance = seen[:kept, :kept] - np.outer(seen[kept, :kept], seen[kept, :kept])
    error = float(np.abs(covariance - np.eye(kept)).max()) if live.all() else None
    shared = spark.sparkContext.broadcast((mean, into, sums))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, into, sums = shared.value
        share = [float(v) / trace if trace > 0 else None for v in values[:kept]]
        for keys, x in blocks_of(batches, dims):
            z = (x - mean) @ into
            off = [[n * int(v) - s for v, s in zip(row, sums)] for row in x] if _wide(x, n, sums) else n * x - np.array(sums)
            square = [sum(v * v for v in row) for row in off] if isinstance(off, list) else (off * off).sum(axis=1).tolist()
            square = [s if s < 2**63 else None for s in square]
            at = np.repeat(np.arange(len(x)), kept)
            number = np.tile(np.arange(kept), len(x))
            yield pa.RecordBatch.from_arrays([
                keys.take(pa.array(at)), pa.array(number + 1, pa.int32()), pa.array(np.full(len(at), n), pa.int64()),
                pa.array(square, pa.int64()).take(pa.array(at)),
                pa.array(z.ravel(), pa.float64(), mask=np.tile(~live, len(x))),
                pa.array(share, pa.float64()).take(pa.array(number)), pa.array([error] * len(at), pa.float64()),
            ], names=["key", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("key", "x").mapInArrow(project, schema).select(*names)


def _wide(x: np.ndarray, n: int, sums: list[int]) -> bool:
    """Whether n * x - sums or the sum of its squares could pass 64 bits."""
    low, high = int(x.min()), int(x.max())
    far = max(abs(n * v - s) for v in (low, high) for s in (min(sums), max(sums)))
    return max(n * abs(low), n * abs(high), far * far * len(sums)) >= 2**63


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
