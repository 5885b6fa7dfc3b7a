"""Operator 12 against a dense decomposition, and the rows it must take."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from wakeline.llm import whiten
from wakeline.llm.common import table


def brute(vectors):
    """Columns of the contract from all vectors at once: whitened up to the sign of a component."""
    x = np.floor(1024 * np.asarray(vectors, np.float64)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    y = x - sums / n
    values, axes = np.linalg.eigh(y.T @ y / n)
    values, axes = values[::-1], axes[:, ::-1]
    off = n * x.astype(object) - sums.astype(object)
    return n, (off * off).sum(axis=1), y @ axes / np.sqrt(np.maximum(values, 1e-300)), values / values.sum()


def check(rows, keys, vectors, most=8):
    n, deviation, z, explained = brute(vectors)
    at = {k: i for i, k in enumerate(keys)}
    kept = min(most, z.shape[1])
    assert len(rows) == len(keys) * kept
    signs = {}
    for r in rows:
        i, c = at[r.vec_id], r.component - 1
        assert (r.n, r.deviation) == (n, deviation[i])
        assert r.explained == pytest.approx(explained[c], rel=1e-9)
        assert abs(r.identity_error) < 1e-9
        if abs(z[i, c]) > 1e-3:
            sign = signs.setdefault(c, np.sign(r.whitened * z[i, c]))
            assert r.whitened * sign == pytest.approx(z[i, c], rel=1e-7, abs=1e-9)


def test_small_table(spark):
    df = table(spark, SMALL, "embeddings")
    known = df.select("vec_id", "embedding").collect()
    check(whiten.whiten(df.repartition(5)).collect(), [r.vec_id for r in known], [r.embedding for r in known])


@pytest.mark.parametrize("d", [1, 2, 3, 9, 40])
@pytest.mark.parametrize("kind", ["plain", "scales", "clusters", "equal", "rank2", "integers", "one"])
def test_components(d, kind):
    rng = np.random.default_rng(d)
    a = rng.standard_normal((3 * d + 2, d))
    q, _ = np.linalg.qr(rng.standard_normal((d, d)))
    v = {
        "plain": a.T @ a, "scales": (a * 10.0 ** rng.uniform(-3, 3, d)).T @ (a * 10.0 ** rng.uniform(-3, 3, d)),
        "clusters": q @ np.diag(np.repeat([3.0, 1.0], [d // 2, d - d // 2])) @ q.T, "equal": 7 * np.eye(d),
        "rank2": a[:2].T @ a[:2], "integers": np.diag(np.arange(float(d))), "one": np.diag([5.0] + [0.0] * (d - 1)),
    }[kind]
    v = (v + v.T) / 2
    values, axes = whiten.components(v)
    norm = np.linalg.norm(v)
    assert np.abs(values - np.linalg.eigvalsh(v)[::-1]).max() < 1e-13 * norm + 1e-300
    assert np.abs(v @ axes - axes * values).max() < 1e-13 * norm + 1e-300
    assert np.abs(axes.T @ axes - np.eye(d)).max() < 1e-13


def test_polar_factor_of_a_nearly_singular_matrix():
    rng = np.random.default_rng(0)
    q, _ = np.linalg.qr(rng.standard_normal((12, 12)))
    signs = np.where(np.arange(12) % 3 == 0, -1.0, 1.0)
    u = whiten.polar(q @ np.diag(signs * 10.0 ** -np.arange(12.0)) @ q.T)
    assert np.abs(u - q @ np.diag(signs) @ q.T).max() < 1e-4 and np.abs(u @ u - np.eye(12)).max() < 1e-13


def test_rows_that_are_dropped_and_clashing_names(spark):
    rng = np.random.default_rng(3)
    good = [[float(x) for x in rng.standard_normal(3)] for _ in range(40)]
    bad = [None, [], [1.0, None, 2.0], [1.0, math.nan, 2.0], [math.inf, 1.0, 2.0], [1e300, 0.0, 0.0], [1.0, 2.0]]
    rows = [(i, v, "x", 1) for i, v in enumerate(good)] + [(100 + i, v, None, 1) for i, v in enumerate(bad)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, whitened string, n int").repartition(4)
    found = whiten.whiten(df)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(found.collect(), list(range(40)), good)


def test_repeated_rows_null_keys_and_no_variance(spark):
    df = spark.createDataFrame([(None, [1.0, 2.0]), (None, [1.0, 2.0]), (1, [1.0, 3.0])], "vec_id int, embedding array<float>")
    rows = whiten.whiten(df).collect()
    assert len(rows) == 6 and {r.n for r in rows} == {3}
    assert all(r.whitened is None and r.identity_error is None and r.explained < 1e-12 for r in rows if r.component == 2)
    one = whiten.whiten(df.where("vec_id = 1")).collect()
    assert [(r.deviation, r.whitened, r.explained) for r in one] == [(0, None, None)] * 2
    assert whiten.whiten(df.limit(0)).count() == 0


def test_deviation_beyond_64_bits_is_null(spark):
    df = spark.createDataFrame([(1, [1e12]), (2, [-1e12])], "vec_id long, embedding array<double>")
    assert [r.deviation for r in whiten.whiten(df).collect()] == [None, None]


def test_partial_sums_are_bounded(spark):
    df = table(spark, SMALL, "embeddings").repartition(100)
    rows = whiten.whole_numbers(df, "vec_id", "embedding")
    whole = whiten.added(rows, 64, lambda x: x.sum(axis=0, keepdims=True).astype(float))
    exact = [r.s for r in rows.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("s")).sort("i").collect()]
    assert whole.tolist() == exact
