"""Whitening against an eigendecomposition by numpy, and the rows that take no part."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tellerscore.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, whitened string, other string"
NAN, INF = float("nan"), float("inf")


def frame(spark, vectors, parts=3):
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], "clash", "kept") for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def brute(vectors):
    x = [[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(column) for column in zip(*x)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    centred = np.array([[float(n * c - s) / n for c, s in zip(row, sums)] for row in x])
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    return deviations, centred, values[::-1], basis[:, ::-1]


def vectors_of(n, d, seed=1):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, d)) * np.geomspace(2, 0.1, d) @ rng.normal(size=(d, d)) + rng.normal(size=d)).astype(np.float32)


def test_components(spark):
    vectors = vectors_of(700, 12)
    df = frame(spark, vectors)
    model = whitening.fit(df)
    deviations, centred, values, basis = brute(vectors)
    np.testing.assert_allclose(model.eigenvalues, values[:8], rtol=1e-10)
    np.testing.assert_allclose(model.explained, values[:8] / values.sum(), rtol=1e-10)
    assert model.identity_error < 1e-10
    rows = sorted(whitening.whiten(df, model).collect(), key=lambda r: r["vec_id"])
    assert [r["deviation"] for r in rows] == deviations
    assert rows[0]["other"] == "kept" and rows[0].asDict().keys() == {"vec_id", "embedding", "other", "deviation", "whitened"}
    signs = np.sign((basis[:, :8] * model.components).sum(axis=0))
    np.testing.assert_allclose([r["whitened"] for r in rows], centred @ (basis[:, :8] * signs / np.sqrt(values[:8])), atol=1e-8)


def test_odd_vectors_take_no_part(spark):
    good = vectors_of(60, 4).tolist()
    odd = [None, [], [1.0] * 3, [1.0] * 5, [1.0, None, 2.0, 3.0], [NAN, 1, 1, 1], [1, INF, 1, 1], [1, 1, -INF, 1], [2.0**52, 1, 1, 1]]
    df = frame(spark, [*good, *odd, good[0], good[0]])
    model = whitening.fit(df)
    assert (model.centre.n, model.dimension, len(model.eigenvalues)) == (62, 4, 4)
    found = {r["vec_id"]: r for r in whitening.whiten(df, model).collect()}
    assert sorted(found) == [*range(60), 69, 70]
    assert found[69]["whitened"] == found[0]["whitened"] == found[70]["whitened"]
    deviations, *_ = brute([*good, good[0], good[0]])
    assert [found[i]["deviation"] for i in [*range(60), 69, 70]] == deviations


@pytest.mark.parametrize("dependent", [1, 3])
def test_dependent_columns(spark, dependent):
    """Directions without variance are no components, and harm no others."""
    base = np.round(vectors_of(300, 5) * 1024) / 1024
    vectors = np.column_stack([base, base[:, :dependent] + base[:, 1 : 1 + dependent], np.full(len(base), 7.0)])
    model = whitening.fit(frame(spark, vectors), components=20)
    assert len(model.eigenvalues) == 5
    _, _, values, _ = brute(vectors)
    np.testing.assert_allclose(model.eigenvalues, values[:5], rtol=1e-9)
    assert model.identity_error < 1e-8


def test_ill_conditioned(spark):
    """Variances from 1e12 down to about 0.1: one plain factorisation of the Gram matrix would lose the last."""
    vectors = vectors_of(400, 6) @ np.diag([1e6, 1e4, 1e3, 10, 1, 1e-3])
    model = whitening.fit(frame(spark, vectors))
    assert len(model.eigenvalues) == 6 and model.identity_error < 1e-6


def test_large_entries(spark):
    """Sums beyond 64 bits stay exact; deviations beyond them are null."""
    vectors = [[2.0**51, 0.5], [-(2.0**51), 0.25], [2.0**50, 0.125]] * 5
    df = frame(spark, vectors)
    model = whitening.fit(df)
    sums = [sum(math.floor(1024 * v[i]) + 100_000 for v in vectors) for i in range(2)]
    assert [int(w) * 15 + int(r) for w, r in zip(model.centre.whole, model.centre.rest)] == sums
    assert whitening.whiten(df, model).where("deviation IS NOT NULL").count() == 0


@pytest.mark.parametrize("vectors", [[], [None, []], [[1.0, 2.0]], [[1.0, 2.0]] * 9])
def test_no_variance(spark, vectors):
    df = frame(spark, vectors, 1)
    model = whitening.fit(df)
    rows = whitening.whiten(df, model).collect()
    assert len(model.eigenvalues) == 0 and model.identity_error == 0
    assert len(rows) == sum(bool(v) for v in vectors) and all(r["whitened"] == [] and r["deviation"] == 0 for r in rows)


def test_passes_shuffle_only_matrices(spark):
    """No exchange but those of sums: vectors stay where they are."""
    df = frame(spark, vectors_of(50, 4), 1)
    model = whitening.fit(df)
    plan = whitening.whiten(df.where(F.col("vec_id") >= 0), model)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan
