import math
from fractions import Fraction

import numpy as np
import pytest

from closeledger.llm.whitening import eigenpairs, op12_whitening, polar, split, whiten

SCHEMA = "vec_id long, embedding array<double>, label int, n string, component string, i string"


def brute(vectors, count=8):
    """Mean, components and eigenvalues by the library's solver, deviations by
    whole numbers."""
    x = [[math.floor(1024 * float(c)) + 100000 for c in v] for v in vectors]
    n, s = len(x), [sum(c) for c in zip(*x, strict=True)]
    deviations = [sum((n * c - t) ** 2 for c, t in zip(v, s, strict=True)) for v in x]
    centred = np.array([[float(c - Fraction(t, n)) for c, t in zip(v, s, strict=True)] for v in x])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:count], vectors[:, ::-1][:, :count]
    keep = values > 1e-12 * np.trace(covariance)
    return n, deviations, centred @ vectors[:, keep] / np.sqrt(values[keep]), values[keep] / np.trace(covariance)


def check(frame, ids, vectors, count=8, tolerance=1e-7):
    n, deviations, white, explained = brute(vectors, count)
    rows = frame.collect()
    assert sorted((r.vec_id, r.component) for r in rows) == sorted((i, c + 1) for i in ids for c in range(len(explained)))
    assert {r.n for r in rows} == {n} and len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-9
    at = {i: k for k, i in enumerate(ids)}
    got = np.zeros(white.shape)
    for r in rows:
        assert r.deviation == (deviations[at[r.vec_id]] if deviations[at[r.vec_id]] < 1 << 63 else None)
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
        got[at[r.vec_id], r.component - 1] = r.whitened
    assert np.abs(got * np.sign((got * white).sum(axis=0)) - white).max() < tolerance


@pytest.mark.parametrize("kind", ["full", "flat", "close", "pairs", "diagonal", "huge"])
@pytest.mark.parametrize("d", [1, 2, 7, 40])
def test_eigenpairs(kind, d):
    rng = np.random.default_rng(d)
    g = rng.normal(size=(3 * d, d))
    a = {
        "full": g.T @ g,
        "flat": g[: max(1, d // 3)].T @ g[: max(1, d // 3)],
        "close": np.eye(d) + 1e-9 * (g.T @ g),
        "pairs": np.linalg.qr(g[:d])[0] @ np.diag(np.arange(d) // 2 + 1.0) @ np.linalg.qr(g[:d])[0].T,
        "diagonal": np.diag(np.arange(d, 0.0, -1)),
        "huge": 1e12 * np.eye(d) + g.T @ g,
    }[kind]
    a = (a + a.T) / 2
    values, vectors = eigenpairs(a, 8)
    top = np.abs(a).max()
    assert len(values) == min(8, d)
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1][:8]).max() < 1e-13 * top
    assert np.abs(a @ vectors - vectors * values).max() < 1e-13 * top
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13


def test_polar_and_split():
    rng = np.random.default_rng(0)
    q, _ = np.linalg.qr(rng.normal(size=(6, 6)))
    a = q @ np.diag([9, 5, 1e-3, -1e-9, -2, -7.0]) @ q.T
    u = polar((a + a.T) / 2)
    assert np.abs(u - q @ np.diag([1, 1, 1, -1, -1, -1.0]) @ q.T).max() < 1e-5 and np.abs(u @ u - np.eye(6)).max() < 1e-14
    upper, lower = split((a + a.T) / 2)
    assert np.abs(upper.T @ a @ lower).max() < 1e-14 * 9 and upper.shape[1] + lower.shape[1] == 6
    assert split(np.eye(4) * 3) is None and split(np.zeros((3, 3))) is None


def test_odd_vectors_leave_and_the_rest_is_whitened(spark):
    rng = np.random.default_rng(1)
    good = [[float(c) for c in v] for v in rng.normal(size=(60, 5)) * [3, 2, 1, 0.5, 0.1]] + [[0.0] * 5] * 30
    bad = [None, [], [1.0, None, 0.0, 0.0, 0.0], [float("nan")] * 5, [float("inf"), 0.0, 0.0, 0.0, 0.0], [1.0, 2.0], [None] * 5]
    rows = [(i, v) for i, v in enumerate(good)] + [(1000 + i, v) for i, v in enumerate(bad)]
    table = spark.createDataFrame([(*r, 1, "a", "b", "c") for r in rows], SCHEMA).repartition(4)
    check(whiten(table, "vec_id", "embedding"), list(range(90)), good)
    check(whiten(table, "vec_id", "embedding", 2), list(range(90)), good, 2)


def test_flat_directions_repeats_and_null_ids(spark):
    rng = np.random.default_rng(2)
    flat = [[float(a), float(a), 7.0] for a in rng.normal(size=20)]
    table = spark.createDataFrame([(i, v, 1, "a", "b", "c") for i, v in enumerate(flat)], SCHEMA)
    check(whiten(table, "vec_id", "embedding"), list(range(20)), flat)
    twice = table.unionByName(table).selectExpr("cast(null as long) vec_id", "embedding")
    got = whiten(twice, "vec_id", "embedding").collect()
    assert len(got) == 40 and all(r.vec_id is None and r.n == 40 for r in got)


def test_large_entries_have_exact_deviations(spark):
    rng = np.random.default_rng(3)
    wide = [[float(a), float(b) * 1e12] for a, b in rng.normal(size=(9, 2))]
    table = spark.createDataFrame([(i, v, 1, "a", "b", "c") for i, v in enumerate(wide)], SCHEMA)
    n, deviations, _, _ = brute(wide)
    assert {r.vec_id: r.deviation for r in whiten(table, "vec_id", "embedding").collect()} == {
        i: v if v < 1 << 63 else None for i, v in enumerate(deviations)
    }
    assert any(v >= 1 << 63 for v in deviations)


@pytest.mark.parametrize("rows", [[], [(1, None, 1, "a", "b", "c")], [(1, [], 1, "a", "b", "c")], [(1, [2.0, 3.0], 1, "a", "b", "c")] * 3])
def test_no_rows_without_variance(spark, rows):
    found = whiten(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding")
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and not found.collect()


def test_query_matches_brute_force(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    check(op12_whitening(spark, sf), [r.vec_id for r in rows], [r.embedding for r in rows])
