"""Whitening against an eigenvalue problem of the exact covariance, in plain numpy."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from plumbline.llm import queries, whitening
from plumbline.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, x string, row string, whitened string"


def frame(spark, vectors, kind="float"):
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], "x", None, "w") for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA.replace("float", kind)).repartition(3)


def brute(vectors, kind="float"):
    """({row: x}, n, sums, components, variances) in exact whole numbers as far as the covariance."""
    kept = {i: v for i, v in enumerate(vectors) if v is not None and all(c is not None and math.isfinite(c) for c in v)}
    width = max((len(v) for v in kept.values()), default=0)
    xs = {i: tuple(math.floor(256 * float(np.float32(c) if kind == "float" else c)) for c in v) + (0,) * (width - len(v)) for i, v in kept.items()}
    fit = sorted(set(xs.values()))
    n, sums = len(fit), [sum(x[j] for x in fit) for j in range(width)]
    centred = [[n * v - s for v, s in zip(x, sums)] for x in fit]
    gram = [[float(Fraction(sum(a[i] * a[j] for a in centred), n**3)) for j in range(width)] for i in range(width)]
    eigen, vectors_of = np.linalg.eigh(np.array(gram).reshape(width, width))
    return xs, n, sums, vectors_of.T[::-1], eigen[::-1]


def compared(spark, vectors, kind="float"):
    df = frame(spark, vectors, kind)
    xs, n, sums, components, variances = brute(vectors, kind)
    model = whitening.fit(df)
    assert (model.n, model.sums) == (n, sums)
    assert np.allclose(model.variances, variances, rtol=1e-8, atol=1e-9 * max(variances[0], 1e-300))
    out = {r.row.vec_id: r for r in whitening.transform(df, model).collect()}
    assert sorted(out) == sorted(xs)
    live = [k for k in range(min(4, len(sums))) if variances[k] > 1e-9 * max(variances[0], 1e-300)]
    signs = [np.sign(components[k] @ model.components[k]) for k in range(len(sums))]
    for i, x in xs.items():
        assert int(out[i].deviation) == sum((n * v - s) ** 2 for v, s in zip(x, sums))
        assert len(out[i].whitened) == min(4, len(sums))
        for k, got in enumerate(out[i].whitened):
            if k in live:
                told = signs[k] * sum((v - s / n) * c for v, s, c in zip(x, sums, components[k])) / math.sqrt(variances[k])
                assert abs(got - told) < 1e-6 * (1 + abs(told))
            else:
                assert got is None
    assert model.identity_error is None if not live else model.identity_error < 1e-9
    return model


def spread(rng, n, d):
    """Vectors whose variances are far enough apart to have well-defined components."""
    return (rng.normal(size=(n, d)) * 1.7 ** -np.arange(d) * 3).tolist()


def test_against_numpy(spark):
    rng = np.random.default_rng(1)
    vectors = spread(rng, 300, 7)
    vectors += [vectors[5]] * 150 + [None, [float("nan")] * 7, [1.0] * 6 + [float("inf")], [None] + [0.5] * 6, vectors[8], [0.25, -0.5], []]
    model = compared(spark, vectors)
    assert model.factors and model.identity_error < 1e-12


def test_dependent_and_constant_dimensions(spark):
    base = spread(np.random.default_rng(2), 200, 4)
    model = compared(spark, [[*v, math.floor(256 * v[0]) / 128, 3.0, v[1]] for v in base], "double")
    assert (model.variances[4:] == 0).all()


def test_steep_variances(spark):
    rng = np.random.default_rng(3)
    compared(spark, (rng.normal(size=(400, 5)) * [1e4, 1e3, 1e2, 10, 1]).tolist(), "double")


@pytest.mark.parametrize("vectors", [[[1.5, 2.0]], [[1.5, 2.0]] * 4, [[0.5], [0.75], [-1.0]], [[], []]])
def test_few_vectors(spark, vectors):
    df = frame(spark, vectors)
    model = whitening.fit(df)
    out = whitening.transform(df, model).collect()
    assert len(out) == len(vectors) and all(len(r.whitened) == len(vectors[0]) for r in out)
    if len(set(map(tuple, vectors))) == 1:
        assert all(c is None for r in out for c in r.whitened) and model.identity_error is None


@pytest.mark.parametrize("vectors", [[], [None, [None], [float("nan")]]])
def test_nothing_to_fit(spark, vectors):
    df = frame(spark, vectors)
    assert whitening.fit(df) is None and whitening.transform(df, None).collect() == []


def test_far_entries_and_wide_vectors(spark):
    df = frame(spark, [[1e30, 1.0], [-1e30, 2.0], [1e17, 3.0]], "double")
    out = whitening.transform(df, whitening.fit(df)).collect()
    assert len(out) == 3
    with pytest.raises(ValueError):
        whitening.fit(frame(spark, [[0.0] * (whitening.DIMENSIONS + 1)]))


def test_big_deviations_are_exact():
    x = np.array([[2**40, -(2**41)], [3, 5]])
    assert whitening._deviations(x, 10**6, [7, -9]) == [sum((10**6 * v - s) ** 2 for v, s in zip(line, (7, -9))) for line in x.tolist()]


def test_query_has_every_row_and_component(spark):
    rows = table(spark, "/root/testdata/sf0.001", "embeddings").select("vec_id", "embedding").collect()
    out = queries.op12_whitening(spark, "/root/testdata/sf0.001").collect()
    assert sorted((r.vec_id, r.component) for r in out) == sorted((r.vec_id, k) for r in rows for k in range(1, 5))
    assert max(r.identity_error for r in out) < 1e-9
    xs, n, sums, components, variances = brute([r.embedding for r in rows])
    explained = {r.component: r.explained for r in out}
    for k in range(4):
        assert abs(explained[k + 1] / (variances[k] / variances.sum()) - 1) < 1e-9
        got = np.array([r.whitened for r in sorted(out, key=lambda r: r.vec_id) if r.component == k + 1])
        told = (np.array([xs[i] for i in range(len(rows))]) - np.array(sums) / n) @ components[k] / np.sqrt(variances[k])
        assert min(np.abs(got - told).max(), np.abs(got + told).max()) < 1e-8
