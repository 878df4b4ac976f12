"""Whitening against a plain eigendecomposition, and its spectral divide and conquer on awkward spectra."""

import math

import numpy as np
import pytest

from claimlake.llm import catalog, whitening


def expected(rows, most=16, scale=64, offset=1_000_000):
    """{index of row: (deviation, whitened up to sign)}, n and shares of the variance, of vectors that are all usable."""
    x = [tuple(math.floor(scale * float(c)) + offset for c in v) for v in rows]
    fit = sorted(set(x))
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    y = np.array([[n * c - s for c, s in zip(v, sums, strict=True)] for v in fit], float) / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(most, int((values > len(values) * 2.0**-52 * values[0]).sum()))
    mine = np.array([[n * c - s for c, s in zip(v, sums, strict=True)] for v in x], float) / n
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for v in x]
    return n, deviation, mine @ vectors[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def holds(got, rows, tolerance=1e-7, **kw):
    """got: rows of whiten by index of vector."""
    n, deviation, whitened, explained = expected(rows, **kw)
    k = whitened.shape[1]
    assert sorted(got) == [(i, c) for i in range(len(rows)) for c in range(1, k + 1)]
    own = np.array([[got[i, c].whitened for c in range(1, k + 1)] for i in range(len(rows))])
    sign = np.sign((own * whitened).sum(axis=0))
    assert np.abs(own * sign - whitened).max() < tolerance
    for (i, c), r in got.items():
        assert r.n == n and r.deviation == deviation[i] and r.identity_error < 1e-9
        assert abs(r.explained - explained[c - 1]) <= 1e-9 * explained[c - 1] + 1e-15


def test_query_equals_a_plain_eigendecomposition(spark):
    folder = "/root/testdata/sf0.01"
    rows = sorted(spark.read.parquet(f"{folder}/embeddings.parquet").collect(), key=lambda r: r.vec_id)
    at = {r.vec_id: i for i, r in enumerate(rows)}
    holds({(at[r.vec_id], r.component): r for r in catalog.QUERIES["op11_embedding_whitening"](spark, folder).collect()}, [r.embedding for r in rows])


def test_unusable_repeated_and_clashing_rows(spark):
    rng = np.random.default_rng(3)
    good = [[float(v) for v in row] for row in rng.standard_normal((40, 5))]
    good += good[:7] * 3  # copies count once
    odd = [None, [], [1.0] * 4, [1.0, 2.0, None, 3.0, 4.0], [float("nan")] * 5, [float("inf"), 0.0, 0.0, 0.0, 0.0]]
    rows = [(i, v, 0, 0) for i, v in enumerate(good)] + [(1000 + i, v, 0, 0) for i, v in enumerate(odd)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n long, component int").repartition(5)
    holds({(r.vec_id, r.component): r for r in whitening.whiten(table, most=3).collect()}, good, most=3)
    assert whitening.whiten(table.where("vec_id >= 1000 and vec_id <> 1002")).count() == 0
    assert whitening.whiten(table.where("vec_id < 0")).count() == 0
    assert whitening.whiten(table.where("vec_id = 0")).count() == 0  # no variance
    nameless = whitening.whiten(table.selectExpr("cast(null as long) as vec_id", "embedding"), most=2)
    assert nameless.count() == 2 * len(good)


def test_large_numbers_stay_exact(spark):
    rows = [[float(i) * 1e9, float(i % 3) * 1e-3] for i in range(30)]
    table = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")
    got = {(r.vec_id, r.component): r for r in whitening.whiten(table).collect()}
    _, deviation, _, _ = expected(rows)
    assert all(r.deviation == (deviation[i] if deviation[i] < 2**63 else None) for (i, _), r in got.items())
    assert {r.deviation for r in got.values()} >= {None}
    wide = spark.createDataFrame([(0, [1e300, 0.0]), (1, [-1e300, 1.0]), (2, [0.0, 5.0])], "vec_id long, embedding array<double>")
    assert whitening.whiten(wide).where("vec_id = 1").count() >= 1


SPECTRA = [[1, 2, 3], [1, 2, 3, 4, 5], [1] * 5 + [2] * 5 + [3] * 5, [0, 0, 0, 1], [5, 5, 5, 1, 1, 1, 1, 3], [1e-8] * 10 + [1] * 3, [1, 1 + 1e-13, 1 + 2e-13, 2], list(np.logspace(0, -9, 40)), [7.0], [2, 2], [0.0, 0.0]]


@pytest.mark.parametrize("spectrum", SPECTRA)
@pytest.mark.parametrize("rotated", [False, True])
def test_divide_and_conquer(spectrum, rotated):
    d = len(spectrum)
    turn = np.linalg.qr(np.random.default_rng(d).standard_normal((d, d)))[0] if rotated else np.eye(d)
    v = turn @ np.diag(np.array(spectrum, float)) @ turn.T
    values, vectors = whitening.components((v + v.T) / 2, 16)
    want = np.array(sorted((x for x in spectrum if x > d * 2.0**-52 * max(spectrum)), reverse=True)[:16])
    assert np.abs(values - want).max(initial=0) < 1e-12
    assert np.abs(v @ vectors - vectors * values).max(initial=0) < 1e-12
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max(initial=0) < 1e-13


def test_polar_factor():
    a = np.random.default_rng(0).standard_normal((20, 20))
    a = a + a.T
    values, q = np.linalg.eigh(a)
    assert np.abs(whitening.polar(a) - (q * np.sign(values)) @ q.T).max() < 1e-12
