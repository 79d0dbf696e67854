from __future__ import annotations

from fractions import Fraction

import numpy as np
import pytest

from lodgeflow.llm import whitening


def matrix(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))[0]
    a = (q * np.array(values)) @ q.T
    return ((a + a.T) / 2).astype(np.longdouble)


@pytest.mark.parametrize("values", [
    np.linspace(1, 2, 40), np.ones(24), [3.0], [1] * 5 + [2] * 5 + [3 + 1e-9 * i for i in range(8)] + [4 + 1e-13 * i for i in range(8)],
    10.0 ** -np.arange(0, 12, 0.5), [0.0] * 10 + list(np.linspace(1, 1.001, 10)), [1e-30, 2e-30, 2e-30]])
def test_eigenvectors_to_double_precision(values):
    a = matrix(values)
    found, x = whitening.eigen(a)
    top = np.abs(a).max()
    assert np.abs(a @ x - x * found).max() <= 1e-15 * top
    assert np.abs(x.T @ x - np.eye(len(a))).max() <= 1e-15
    assert (np.diff(found) <= 0).all()
    assert np.abs(np.sort(found) - np.sort(values)).max() <= 1e-13 * top * len(a)


def test_correction_squares_the_error():
    a = matrix(np.linspace(1, 2, 20))
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    errors = []
    for _ in range(3):
        x, _, e = whitening.refine_step(a, x)
        errors.append(e)
    assert errors[1] < errors[0] ** 1.6 and errors[2] < 1e-10


def test_near_eigenvalues_form_clusters():
    runs = whitening._clusters(np.array([5.0, 1.0, 1.05, 3.0, 5.05, 5.1]), 0.1)
    assert [sorted(c.tolist()) for c in runs] == [[1, 2], [0, 4, 5]]
    # within a cluster the sub-solve tells eigenvalues apart that float32 cannot
    a = matrix([1, 1 + 1e-9, 1 + 3e-9, 2])
    found, x = whitening.eigen(a)
    assert np.abs(x.T @ a @ x - np.diag(found)).max() < 1e-17


def test_packed_vectors_come_back():
    rng = np.random.default_rng(1)
    x = rng.integers(-100, 100, (30, 5)).astype(float)
    x[3, 2], x[4, 0], x[5, 1], x[6] = 2.0 ** 50, -3e4, 1e7, 0
    packed = whitening.pack(x / whitening.SCALE)
    assert (whitening.unpack(packed, 5) == x.astype(np.int64) + whitening.SHIFT).all()
    assert {len(p) for p in packed} == {5, 10, 20, 40}  # the least width each
    assert whitening.unpack([], 5).shape == (0, 5)


def fit_list(spark, rows):
    df = spark.createDataFrame([(i, [float(c) for c in r]) for i, r in enumerate(rows)], "vec_id long, embedding array<double>")
    return whitening.packed_rows(whitening.usable(df), len(rows[0])).select("x")


@pytest.mark.parametrize("scale", [1, 1e4, 2.0 ** 50])
def test_products_are_exact(spark, scale):
    """Also where whole numbers exceed 64 bits."""
    x = (np.random.default_rng(2).integers(-50, 50, (40, 3)) * scale).astype(np.int64)
    fit = fit_list(spark, x / 64)
    n, total, most = whitening.sums(fit, 3)
    want = [sum(int(v) + whitening.SHIFT for v in x[:, i]) for i in range(3)]
    assert (n, total, most) == (40, want, int(np.abs(x).max()))
    centred = whitening.Centred(n, total, most)
    y = [[40 * (int(v) + whitening.SHIFT) - t for v, t in zip(row, total)] for row in x]
    assert whitening.products(fit, 3, centred) == [[sum(r[i] * r[j] for r in y) for j in range(3)] for i in range(3)]
    assert int(whitening.extended(3 ** 40 + 1)) == pytest.approx(3 ** 40 + 1, rel=1e-18)


def brute_covariance(x):
    n, d = len(x), len(x[0])
    mean = [Fraction(sum(r[i] for r in x), n) for i in range(d)]
    return np.array([[float(sum((r[i] - mean[i]) * (r[j] - mean[j]) for r in x) / n) for j in range(d)] for i in range(d)])


def test_whitens_like_brute_force(spark):
    rng = np.random.default_rng(5)
    base = (rng.normal(size=(60, 6)) * [3, 2, 1, 0.5, 0.3, 0.2]).astype(np.float32).astype(float)
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(100, base[0].tolist()), (None, base[1].tolist()), (7, base[7].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = whitening.whiten(df, 4).toPandas()
    x = np.floor(64 * base).astype(np.int64) + 1_000_000
    x = np.unique(x, axis=0)
    v = brute_covariance(x.tolist())
    e, q = np.linalg.eigh(v)
    e, q = e[::-1], q[:, ::-1]
    assert len(got) == 4 * 63 and set(got["n"]) == {len(x)} and got["identity_error"].max() < 1e-12
    total = x.sum(axis=0)
    signs = None
    for vec_id, vector in rows:
        own = np.floor(64 * np.array(vector)).astype(np.int64) + 1_000_000
        part = got[got["vec_id"].isna() if vec_id is None else got["vec_id"] == vec_id].sort_values("component")
        part = part.iloc[::2] if vec_id == 7 else part  # a repeated row gets its results twice
        white = ((own - total / len(x)) @ q / np.sqrt(e))[:4]
        signs = np.sign(white * part["whitened"]) if signs is None else signs
        assert np.abs(white * np.asarray(signs) - part["whitened"]).max() < 1e-9
        assert set(part["deviation"]) == {sum((len(x) * int(a) - int(s)) ** 2 for a, s in zip(own, total))}
        assert np.abs(part["explained"] - e[:4] / np.trace(v)).max() < 1e-12


def test_unusable_rows_are_dropped(spark):
    nan, inf = float("nan"), float("inf")
    good = [[0.1, 0.2], [0.3, 0.1], [0.5, 0.9], [0.2, 0.2]]
    bad = [None, [], [0.1], [0.1, None], [nan, 0.0], [0.0, -inf], [inf, 0.0], [1.0, 2.0 ** 60], [0.1, 0.2, 0.3]]
    rows = [(i, v, "x", 1) for i, v in enumerate(good + bad)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, x string, n int")
    got = whitening.whiten(df).toPandas()
    assert sorted(got["vec_id"].unique()) == [0, 1, 2, 3] and set(got["n"]) == {4} and len(got) == 8
    assert whitening.whiten(df.filter("false")).count() == 0
    assert whitening.whiten(df.filter("vec_id >= 7 AND embedding[0] IS NULL")).count() == 0
    assert whitening.whiten(df.filter("false")).columns == list(got.columns)


def test_components_without_variance(spark):
    rows = [(i, [0.5, i / 64, 2 * i / 64]) for i in range(5)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).toPandas()
    assert len(got) == 15 and got[got["component"] == 1]["whitened"].notna().all()
    assert got[got["component"] > 1]["whitened"].isna().all() and set(got[got["component"] > 1]["explained"]) == {0.0}
    assert got["identity_error"].max() < 1e-12
    same = spark.createDataFrame([(1, [0.1, 0.2]), (2, [0.1, 0.2])], "vec_id long, embedding array<float>")
    one = whitening.whiten(same).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(1, 0, None, None, None)] * 4


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(1, [2.0 ** 54]), (2, [0.0]), (3, [1.0])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert all(r["deviation"] is None for r in got) and len(got) == 3
    assert np.std([r["whitened"] for r in got]) == pytest.approx(1)
