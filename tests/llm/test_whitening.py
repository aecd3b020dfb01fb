"""Whitening against exact integers and the covariance's eigenvectors; the solver on awkward spectra."""

import math
from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, x string, component int, n long, v string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, 2, "v") for i, v in rows], SCHEMA)


def by_hand(rows, components=4):
    """Every figure from exact sums; directions from numpy's symmetric solver."""
    sound = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows
             if v and all(c is not None and math.isfinite(np.float32(c)) for c in v)]
    fit = sorted({tuple(x) for _, x in sound})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[k] for x in fit) for k in range(d)]
    centred = np.array([[float(Fraction(n * x[k] - sums[k], n)) for k in range(d)] for x in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = {}
    for i, x in sound:
        own = np.array([float(Fraction(n * x[k] - sums[k], n)) for k in range(d)])
        for c in range(min(components, d)):
            out.setdefault((i, c + 1), []).append((n, sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True)),
                                                   own @ vectors[:, c] / math.sqrt(values[c]), values[c] / values.sum()))
    return out


def compared(got, want):
    assert sorted((r.vec_id, r.component) for r in got) == sorted(k for k, v in want.items() for _ in v)
    signs = {}
    for r in got:
        n, deviation, whitened, explained = want[r.vec_id, r.component][0]
        assert (r.n, r.deviation) == (n, deviation)
        assert r.explained == pytest.approx(explained, rel=1e-9)
        if abs(whitened) > 1e-6:
            sign = signs.setdefault(r.component, math.copysign(1, r.whitened * whitened))
            whitened *= sign
            assert r.whitened == pytest.approx(whitened, rel=1e-7)
        assert r.identity_error < 1e-9
    assert len({r.identity_error for r in got}) == 1


def test_against_exact_sums(spark):
    rng = np.random.default_rng(5)
    spread = np.linspace(0.05, 0.5, 12)
    rows = [(i, [float(c) for c in rng.standard_normal(12) * spread + 0.3]) for i in range(700)]
    rows += [(700 + i, rows[3][1]) for i in range(900)]  # one vector holds over half of all rows
    rows += [(5, rows[5][1]), (2000, None), (2001, []), (2002, [1.0] * 11 + [None]), (2003, [math.nan] * 12), (2004, [math.inf] + [0.0] * 11)]
    compared(whitening.whiten(frame(spark, rows).repartition(40)).collect(), by_hand(rows))


def test_given_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    got = whitening.whiten(spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")).collect()
    compared(got, by_hand(rows))


def test_few_dimensions_no_spread_other_lengths_and_nothing(spark):
    rows = [(1, [0.5, -0.25]), (2, [0.25, 1.0]), (3, [0.1, 0.2]), (None, [0.1, 0.2]), (4, [1.0, 2.0, 3.0]), (5, [-0.0, -1e-9])]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert sorted({(r.vec_id or 0, r.component) for r in got}) == [(i, c) for i in (0, 1, 2, 3, 5) for c in (1, 2)]
    assert {r.n for r in got} == {4}
    same = whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in same] == [(1, 0, None, None, None)] * 4
    line = whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [2.0, 4.0]), (3, [4.0, 8.0])])).collect()
    assert [r.whitened is None for r in sorted(line, key=lambda r: (r.vec_id, r.component))] == [False, True] * 3
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, None)])).count() == 0


def test_entries_beyond_the_range(spark):
    huge = whitening.whiten(frame(spark, [(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [1e15, 3.0])])).collect()
    assert {r.deviation for r in huge} == {None} and {r.n for r in huge} == {3}
    assert all(r.whitened is not None for r in huge if r.component == 1)


@pytest.mark.parametrize("seed", range(30))
def test_solver_on_random_triangles(seed):
    rng = np.random.default_rng(seed)
    d = int(rng.integers(1, 30))
    a = rng.standard_normal((int(rng.integers(1, 60)), d)) * 10.0 ** rng.uniform(-8, 8, d)
    a = np.round(a / 1e4) if seed % 3 == 0 else a
    solved(a)


@pytest.mark.parametrize("values", [
    [5.0] * 6 + [1.0] * 20, [5, 5 * (1 - 1e-9), 5 * (1 - 2e-9), 5 * (1 - 1e-5), *np.linspace(1, 2, 20)],
    [5, 5 * (1 - 4e-4), 5 * (1 - 8e-4), 5 * (1 - 1.2e-3), 1], [0.0] * 5, [1.0] + [0.0] * 7, list(10.0 ** -np.arange(30))])
def test_solver_on_close_and_small_values(values):
    turn = np.linalg.qr(np.random.default_rng(1).standard_normal((len(values), len(values))))[0]
    solved(np.diag(values) @ turn)


def solved(a):
    d = a.shape[1]
    r = np.linalg.qr(np.vstack([a, np.zeros((d, d))]), mode="r")
    values, vectors = whitening.principal(r, 4)
    top, k = max(values[0], 1e-300), vectors.shape[1]
    assert np.abs(values - np.linalg.svd(r, compute_uv=False) ** 2).max() <= 1e-13 * top
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() <= 1e-12
    assert np.abs(r.T @ (r @ vectors) - vectors * values[:k]).max() <= 1e-13 * top


def test_small_singular_values_keep_their_digits():
    """Of a graded bidiagonal matrix, whose smallest values a covariance would lose."""
    diagonal, above = 10.0 ** -np.arange(0, 20.0, 2), 0.5 * 10.0 ** -np.arange(1, 19.0, 2)
    values = np.sqrt(whitening.dqds(diagonal, above))
    product = np.prod([Fraction(float(v)) for v in diagonal])
    assert float(np.prod([Fraction(float(v)) for v in values])) == pytest.approx(float(product), rel=1e-12)


def test_triangles_of_many_tasks_meet_in_rounds(spark):
    rng = np.random.default_rng(3)
    x = [[int(c) for c in v] for v in rng.integers(-500, 500, (900, 6)) * [1, 2, 3, 4, 5, 6]]
    distinct = spark.createDataFrame([(v,) for v in x], "x array<long>").repartition(40)
    fit = whitening.fitted(distinct, 6)
    centred = np.array(x) - np.mean(x, axis=0)
    values, vectors = np.linalg.eigh(centred.T @ centred / len(x))
    assert fit.roots ** 2 == pytest.approx(values[::-1][:4], rel=1e-12)
    assert np.abs((fit.directions * vectors[:, ::-1][:, :4]).sum(axis=0)) == pytest.approx(np.ones(4), rel=1e-12)
    assert fit.error < 1e-12
