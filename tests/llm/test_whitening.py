"""Whitening against a dense eigensolver."""
import math

import numpy as np
import pytest

from riskloom.llm import whitening
from riskloom.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<double>, x int, n int, component string"


def plain(rows):
    """Per row (vec_id, n, deviation, projections without sign, explained)."""
    good = [(i, [math.floor(256 * c) for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for size in {len(v) for _, v in good}:
        fit = sorted({tuple(v) for _, v in good if len(v) == size})
        n, sums = len(fit), [sum(c) for c in zip(*fit)]
        y = np.array([[c - s / n for c, s in zip(v, sums)] for v in fit]).reshape(n, size)
        values, vectors = np.linalg.eigh(y.T @ y / n) if size else (np.empty(0), np.empty((0, 0)))
        order = [k for k in np.argsort(-values)[:4] if values[k] > 1e-9 * max(values.max(initial=0), 1)]
        for i, v in good:
            if len(v) == size:
                deviation = sum((n * c - s) ** 2 for c, s in zip(v, sums))
                centred = np.array([c - s / n for c, s in zip(v, sums)])
                for place, k in enumerate(order, 1):
                    out.append((i, place, n, deviation, abs(centred @ vectors[:, k]) / math.sqrt(values[k]), values[k] / values.sum()))
    return out


def check(rows, expected):
    def key(r):
        return str(r[0]), r[1], r[3], r[4]

    got = sorted(((r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in rows), key=key)
    expected = sorted(expected, key=key)
    assert [g[:4] for g in got] == [e[:4] for e in expected]
    assert np.allclose([g[4] for g in got], [e[4] for e in expected], atol=1e-8)
    assert np.allclose([g[5] for g in got], [e[5] for e in expected], rtol=1e-9)
    assert all(r.identity_error < 1e-9 for r in rows)


def test_whitening_of_embeddings(spark, folder):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    check(QUERIES["op12_spectrum_whitening"](spark, folder).collect(), plain(rows))


def test_whitening_of_odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, list(map(float, rng.normal(size=6) * [9, 5, 3, 2, 1, 1]))) for i in range(80)]
    rows += rows[:30] * 3 + [(None, [0.0, -0.0, 1.0, 2.0, 3.0, 4.0]), (90, None), (91, [1.0, None, 1.0, 1.0, 1.0, 1.0]),
                             (92, [math.nan] * 6), (93, [math.inf] * 6), (94, [1.0, 2.0]), (95, [2.0, 1.0]), (96, []), (97, [5.0])]
    df = spark.createDataFrame([(i, v, 1, 1, "c") for i, v in rows], SCHEMA).repartition(5)
    check(whitening.whiten(df).collect(), plain(rows))
    assert whitening.whiten(df.limit(0)).count() == 0
    assert whitening.whiten(df.where("vec_id = 1")).count() == 0  # one distinct vector varies in nothing


def test_large_numbers_stay_exact(spark):
    rows = [(i, [c * 1e6 for c in (i, i * i % 7, 1.0)]) for i in range(40)]
    df = spark.createDataFrame([(i, v, 1, 1, "c") for i, v in rows], SCHEMA)
    expected = [(*r[:3], r[3] if r[3] < 2**63 else None, *r[4:]) for r in plain(rows)]
    got = whitening.whiten(df).collect()
    assert sorted((r.vec_id, r.component, r.n, r.deviation) for r in got) == sorted(e[:4] for e in expected)
    huge = spark.createDataFrame([(i, [1e300 * (-1) ** i, float(i)], 1, 1, "c") for i in range(5)], SCHEMA)
    assert all(r.deviation is None and math.isfinite(r.whitened) for r in whitening.whiten(huge).collect())


@pytest.mark.parametrize("values", [
    [9, 7, 5, 3, 1, 0.5], [5, 5, 5, 5, 5], [5, 5, 4, 4, 1], [1, 0, 0, 0], [0, 0, 0], [3, 3 - 1e-9, 2, 2 - 1e-12, 1], [1e-30, 2e-30], [7],
])
def test_slicing_equals_a_dense_solver(values):
    rng = np.random.default_rng(len(values))
    turn = np.linalg.qr(rng.normal(size=(len(values), len(values))))[0]
    matrix = turn @ np.diag(values) @ turn.T
    found, vectors = whitening.leading(matrix)
    expected = [v for v in sorted(values, reverse=True)[:4] if v > 1e-12 * max(values)]
    assert np.allclose(found, expected, rtol=1e-12)
    assert np.allclose(vectors @ vectors.T, np.eye(len(found)), atol=1e-10)
    assert np.abs(vectors @ matrix - found[:, None] * vectors).max(initial=0) <= 1e-13 * max(max(values), 1e-30) * 10


@pytest.mark.parametrize("seed", range(5))
def test_inertia_counts_eigenvalues(seed):
    rng = np.random.default_rng(seed)
    a = rng.normal(size=(20, 20))
    a = a + a.T
    values = np.linalg.eigvalsh(a)
    for shift in [-5.0, 0.0, 1.5, 4.0]:
        assert whitening.inertia(a, shift) == (sum(values < shift), sum(values > shift))
    assert whitening.inertia(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == (1, 1)
    assert whitening.inertia(np.zeros((3, 3)), 0.0) == (0, 0)
