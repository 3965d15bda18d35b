"""Embedding whitening against numpy's dense eigenvectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from forgeline.llm import whitening as W

ROWS = "vec_id long, embedding array<float>, id string, n string, dims string, x string, component string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, "a", "b", None, "d", "e") for i, v in rows], ROWS).repartition(parts)


def dense(vectors):
    x = np.floor(1024 * np.array(vectors, np.float32).astype(np.float64)).astype(np.int64) + 100_000
    n = len(x)
    sums = [sum(map(int, c)) for c in x.T]
    deviation = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    y = x - np.array(sums) / n
    v = y.T @ y / n
    e, u = np.linalg.eigh(v)
    return y, v, e[::-1], u[:, ::-1], deviation


def test_minres_solves_symmetric_systems():
    rng = np.random.default_rng(1)
    a = rng.standard_normal((9, 9))
    a = a + a.T                                                  # indefinite
    rhs = np.column_stack([rng.standard_normal((9, 2)), np.zeros(9)])
    x = W.minres(lambda t: a @ t, rhs, 9)
    assert np.abs(a @ x - rhs).max() < 1e-8
    short = W.minres(lambda t: a @ t, rhs, 3)                     # minimal residual over the Krylov space
    krylov = np.linalg.qr(np.column_stack([rhs[:, 0], a @ rhs[:, 0], a @ a @ rhs[:, 0]]))[0]
    best = krylov @ np.linalg.lstsq(a @ krylov, rhs[:, 0], rcond=None)[0]
    assert np.abs(short[:, 0] - best).max() < 1e-8


@pytest.mark.parametrize("dims,count", [(1, 1), (3, 3), (64, 8), (300, 8), (40, 40)])
def test_eigenpairs(dims, count):
    rng = np.random.default_rng(dims)
    q = np.linalg.qr(rng.standard_normal((dims, dims)))[0]
    e = np.sort(rng.uniform(90, 100, dims))[::-1]                # close together
    a = q * e @ q.T
    a = (a + a.T) / 2
    passes = []
    values, u = W.largest_eigenpairs(lambda w: passes.append(1) or a @ w, dims, count)
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1][:count]).max() < 1e-11 and (np.diff(values) <= 0).all()
    assert np.linalg.norm(a @ u - u * values, axis=0).max() < 1e-11 and np.abs(u.T @ u - np.eye(count)).max() < 1e-13
    assert len(passes) < 400


def test_repeated_eigenvalues_and_low_rank():
    a = np.diag([5.0] * 12 + [1.0] * 20)
    values, u = W.largest_eigenpairs(lambda w: a @ w, 32, 8)
    assert np.abs(values - 5).max() < 1e-12 and np.abs(u[12:]).max() < 1e-9
    b = np.outer(np.arange(20.0), np.arange(20.0))
    values, _ = W.largest_eigenpairs(lambda w: b @ w, 20, 8)
    assert abs(values[0] - b.trace()) < 1e-9 and np.abs(values[1:]).max() < 1e-9


def test_equal_to_dense_eigenvectors(spark):
    rng = np.random.default_rng(3)
    good = (rng.standard_normal((700, 20)) * np.linspace(2, 0.3, 20) + rng.standard_normal(20)).astype(np.float32)
    good[600:] = good[:100]                                      # copies
    rows = [(i % 690, [float(c) for c in v]) for i, v in enumerate(good)]
    bad = [(900, None), (901, []), (902, [1.0, None] + [0.0] * 18), (903, [float("nan")] * 20), (904, [float("inf")] + [0.0] * 19), (905, [1.0, 2.0]),
           (906, [1e30] * 20)]
    got = W.whiten(frame(spark, [*rows, *bad, (None, rows[0][1])]), 8).collect()
    y, v, e, u, deviation = dense([r[1] for r in rows] + [rows[0][1]])
    assert len(got) == 701 * 8 and {r.n for r in got} == {701}
    assert sorted((r.id is None, r.id or 0, r.deviation) for r in got) == \
        sorted((i is None, i or 0, d) for i, d in zip([r[0] for r in rows] + [None], deviation) for _ in range(8))
    white = y @ (u[:, :8] / np.sqrt(e[:8]))
    for k in range(8):
        mine = np.array(sorted(r.whitened for r in got if r.component == k + 1))
        assert min(np.abs(mine - np.sort(s * white[:, k])).max() for s in (1, -1)) < 1e-9
        assert {round(r.explained, 12) for r in got if r.component == k + 1} == {round(e[k] / v.trace(), 12)}
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-10


def test_degenerate_tables(spark):
    empty = frame(spark, [(1, [1.0])], 1).limit(0)
    assert W.whiten(empty).count() == 0 and W.whiten(empty).columns[:2] == ["id", "component"]
    assert W.whiten(frame(spark, [(1, [1.0, 2.0])])).count() == 0                      # one vector: no variance
    assert W.whiten(frame(spark, [(i, [0.5, 0.25]) for i in range(9)])).count() == 0   # equal vectors
    assert W.whiten(frame(spark, [(1, None), (2, [])])).count() == 0
    line = W.whiten(frame(spark, [(i, [float(i), 2.0 * i, 7.0]) for i in range(5)])).collect()
    assert {r.component for r in line} == {1} and abs(line[0].explained - 1) < 1e-12


def test_long_and_deep_tables(spark):
    big = W.whiten(frame(spark, [(i, [1e9 * (i % 3), 1.0]) for i in range(30)])).collect()
    assert {(r.id % 3, r.deviation) for r in big} == {(0, None), (1, 0), (2, None)}       # beyond a long, or exact
    wide = W.whiten(frame(spark, [(i, [float(np.sin(i * j)) for j in range(50)]) for i in range(400)], 9), 4)
    assert wide.count() == 1600
    other = wide.sparkSession.createDataFrame([(str(i), [float(np.sin(i * j)) for j in range(50)]) for i in range(400)], "vec_id string, embedding array<double>")
    assert W.whiten(other.withColumn("embedding", F.col("embedding")), 4).count() == 1600


def test_partial_results_in_groups(spark, monkeypatch):
    rows = [(i, [float(i % 7), float(i % 5), float(i % 3)]) for i in range(210)]
    want = {(r.id, r.component): abs(r.whitened) for r in W.whiten(frame(spark, rows, 8)).collect()}
    monkeypatch.setattr(W, "FAN_IN", 2)
    got = {(r.id, r.component): abs(r.whitened) for r in W.whiten(frame(spark, rows, 8)).collect()}
    assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in want) < 1e-10
