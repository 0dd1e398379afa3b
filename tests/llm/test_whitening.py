"""Spectrum slicing against a plain eigensolver, whitening against numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsflow.llm import whitening as W

FLOATS = "vec_id long, embedding array<float>, id string, component int"


def symmetric(values, seed=1):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    a = q * np.array(values, float) @ q.T
    return (a + a.T) / 2


SPECTRA = [
    [5.0, 3.0, 1.0, 0.5], [7.0], [1e6, 1.0, 1e-3, 1e-4], [2.0, 2.0, 2.0, 1.0, 1.0, 0.1], [1.0] * 8,
    [4.0, 4.0 - 1e-9, 4.0 - 2e-9, 1.0], [3.0, 2.0, 0.0, 0.0, 0.0], list(np.linspace(40, 50, 64)),
    list(1.3 ** -np.arange(48.0)), [9.0, 9.0 - 1e-14, 1.0], [1e-8, 1e-9, 0.0],
]


@pytest.mark.parametrize("values", SPECTRA)
def test_inertia_counts(values):
    a = symmetric(values)
    top = max(values)
    for shift in (-top, 0.3 * top, 0.77 * top, 2 * top, (values[0] + values[-1]) / 2 + 0.01 * top):
        assert W.positive(a, shift) == sum(v > shift for v in values)


def test_inertia_of_pivots_that_are_zero():
    assert W.positive(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1
    assert W.positive(np.zeros((3, 3)), 0.0) == 0
    assert W.positive(np.zeros((0, 0)), 0.0) == 0


@pytest.mark.parametrize("values", SPECTRA)
@pytest.mark.parametrize("wanted", [1, 3, 32])
def test_leading(values, wanted):
    a = symmetric(values)
    got = W.leading(a, min(wanted, len(values)))
    expected = [v for v in np.linalg.eigvalsh(a)[::-1][:wanted] if v > 1e-13 * np.trace(a)]
    assert len(got.values) >= sum(v > 1e-12 * max(values) for v in values[:wanted])
    assert len(got.values) <= len([v for v in expected if v > 0]) + 1
    np.testing.assert_allclose(got.values, expected[:len(got.values)], rtol=1e-12, atol=1e-13 * max(values))
    u = got.vectors
    np.testing.assert_allclose(u.T @ u, np.eye(u.shape[1]), atol=1e-12)
    assert np.abs(a @ u - u * got.values).max(initial=0) < 1e-12 * max(values)


@pytest.mark.parametrize("seed", range(20))
def test_leading_of_random_covariances(seed):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((rng.integers(2, 200), rng.integers(1, 40)))
    a = np.cov(x.T, bias=True).reshape(x.shape[1], x.shape[1])
    got, expected = W.leading(a, min(32, len(a))), np.linalg.eigvalsh(a)[::-1][:32]
    n = len(got.values)
    assert n >= min(len(x) - 1, x.shape[1], 32)
    np.testing.assert_allclose(got.values, expected[:n], rtol=1e-10)
    assert np.abs(a @ got.vectors - got.vectors * got.values).max() < 1e-11 * expected[0]


def plain(rows, k):
    x = np.floor(64 * rows.astype(np.float64)) + 1_000_000
    centred = x - x.mean(axis=0)
    v = centred.T @ centred / len(x)
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return x.astype(np.int64), centred @ u / np.sqrt(e), e / np.trace(v)


def test_whitened_rows(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.standard_normal((700, 40)) @ rng.standard_normal((40, 40))).astype(np.float32)
    rows = [(i, v.tolist(), "x", 9) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, FLOATS).repartition(5)
    got = W.whiten(frame).toPandas().sort_values(["id", "component"])
    x, white, explained = plain(vectors, 32)
    assert len(got) == 700 * 32 and set(got.n) == {700}
    mine = got.whitened.to_numpy().reshape(700, 32)
    signs = np.sign((mine * white).sum(axis=0))
    np.testing.assert_allclose(mine, white * signs, atol=1e-8)
    np.testing.assert_allclose(got.explained.to_numpy()[:32], explained, rtol=1e-9)
    deviations = ((700 * x - x.sum(axis=0)) ** 2).sum(axis=1)
    assert got.deviation.to_numpy().reshape(700, 32)[:, 0].tolist() == deviations.tolist()
    error = np.abs(mine.T @ mine / 700 - np.eye(32)).max()
    assert abs(got.identity_error.iloc[0] - error) < 1e-9 and error < 1e-9 and got.identity_error.nunique() == 1


def test_odd_rows(spark):
    good = [(1, [1.0, 2.0], "a", 1), (1, [1.0, 2.0], "a", 1), (None, [3.0, 1.0], None, None), (4, [0.5, -2.0], "", 0)]
    bad = [(5, None, "b", 1), (6, [None, 1.0], "b", 1), (7, [math.inf, 1.0], "b", 1), (8, [1.0, math.nan], "b", 1),
           (9, [1.0], "b", 1), (10, [], "b", 1)]
    got = W.whiten(spark.createDataFrame(good + bad, FLOATS)).collect()
    assert sorted([r.id is None and -1 or r.id for r in got]) == [-1, -1, 1, 1, 1, 1, 4, 4]
    assert {r.n for r in got} == {4} and all(r.identity_error < 1e-12 for r in got)
    assert {r.component for r in got} == {1, 2}


def test_no_variance_and_no_rows(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0, 3.0], "a", 1) for i in range(9)], FLOATS)
    assert W.whiten(same).collect() == []
    assert W.whiten(same.where("vec_id < 0")).collect() == []
    # One direction only: one component.
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0], "a", 1) for i in range(9)], FLOATS)
    got = W.whiten(line).collect()
    assert {r.component for r in got} == {1} and abs(got[0].explained - 1) < 1e-12


def test_large_components_stay_exact(spark):
    vectors = [[2.0**30, 1.0], [-(2.0**30), 2.0], [2.0**29, 7.0]]
    frame = spark.createDataFrame([(i, v, "a", 1) for i, v in enumerate(vectors)], FLOATS)
    got = {(r.id, r.component): r for r in W.whiten(frame).collect()}
    x, white, _ = plain(np.array(vectors), 1)
    exact = [sum((3 * int(a) - int(s)) ** 2 for a, s in zip(r, x.astype(object).sum(axis=0))) for r in x]
    assert [got[i, 1].deviation for i in range(3)] == [d if d < 2**63 else None for d in exact]
    assert abs(abs(got[0, 1].whitened) - abs(white[0, 0])) < 1e-9
    with pytest.raises(Exception, match="53 bits"):
        W.whiten(spark.createDataFrame([(1, [1e30], "a", 1)], FLOATS)).collect()


def test_query_against_numpy(spark, sf_dir):
    from newsflow.llm.queries import op12_spectrum_whitening

    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    keep = [v is not None and all(c is not None and math.isfinite(c) for c in v) for v in rows.embedding]
    rows = rows[keep].reset_index(drop=True)
    got = op12_spectrum_whitening(spark, sf_dir).orderBy("vec_id", "component").toPandas()
    _, white, explained = plain(np.array(rows.embedding.tolist()), 32)
    mine = got.whitened.to_numpy().reshape(len(rows), 32)
    order = np.argsort(rows.vec_id.to_numpy(), kind="stable")
    signs = np.sign((mine * white[order]).sum(axis=0))
    np.testing.assert_allclose(mine, white[order] * signs, atol=1e-7)
    np.testing.assert_allclose(got.explained.to_numpy()[:32], explained, rtol=1e-8)
