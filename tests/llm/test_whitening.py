from math import floor

import numpy as np
import pytest

from andenlake.llm import whitening
from andenlake.llm.spectrum import Slicer, inertia, leading

SCHEMA = "vec_id long, embedding array<double>, component int, n string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)


def check(spark, rows, size, repeat=1):
    """Against numpy's dense eigenvalues over the rows that should take part."""
    used = [(i, v) for i, v in rows if v is not None and len(v) == size
            and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[floor(1024 * c) + 100000 for c in v] for _, v in used], "i8")
    n = len(x)
    total = x.sum(0).astype(object)
    got = whitening.whiten(frame(spark, rows)).toPandas()
    m = min(8, size)
    assert len(got) == n * m and (got["n"] == n).all()
    assert sorted(got["component"].unique()) == list(range(1, m + 1))
    apart = n * x.astype(object) - total
    want = sorted((str(i), int((a ** 2).sum())) for (i, _), a in zip(used, apart))
    one = got[got["component"] == 1]
    assert sorted((str(None if np.isnan(i) else int(i)), d) for i, d in zip(
        one["vec_id"].astype(float), one["deviation"])) == want
    cov = (apart.T @ apart).astype("f8") / n ** 3
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    got_values = got.groupby("component")["explained"].first().to_numpy() * np.trace(cov)
    assert np.allclose(got_values, values[:m], rtol=1e-9, atol=1e-9 * values[0])
    assert got["identity_error"].nunique() == 1 and got["identity_error"].max() <= 1e-6
    return got, used, (apart / n).astype("f8"), values, axes


def test_against_dense_eigenvectors(spark):
    rng = np.random.default_rng(1)
    data = rng.standard_normal((400, 12)) * np.geomspace(5, 0.1, 12)
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    rows += [(None, data[3].tolist()), (7, data[7].tolist()), (900, None), (901, []),
             (902, [1.0] * 11 + [None]), (903, [1.0] * 11 + [float("nan")]),
             (904, [1.0] * 11 + [float("-inf")]), (905, [1.0, 2.0])]
    got, used, apart, values, axes = check(spark, rows, 12)
    for k in range(8):
        mine = got[got["component"] == k + 1].sort_values("vec_id")
        mine = mine[mine["vec_id"].notna()]
        order = sorted((i, j) for j, (i, _) in enumerate(used) if i is not None)
        want = np.array([apart[j] @ axes[:, k] / values[k] ** 0.5 for _, j in order])
        have = mine["whitened"].to_numpy()
        assert min(np.abs(have - want).max(), np.abs(have + want).max()) < 1e-6


def test_equal_eigenvalues_and_few_vectors(spark):
    # Every axis the same: any orthonormal basis will do, the covariance must be the identity.
    rows = [(2 * i + s, ((2 * s - 1) * np.eye(10)[i]).tolist()) for i in range(10) for s in (0, 1)]
    check(spark, rows, 10)
    check(spark, rows[:6], 10)  # rank 3: the rest has no variance


def test_no_variance(spark):
    got = whitening.whiten(frame(spark, [(i, [0.5] * 3) for i in range(4)])).toPandas()
    assert len(got) == 12 and got["whitened"].isna().all() and got["explained"].isna().all()
    assert (got["deviation"] == 0).all() and (got["identity_error"] == 0).all()


def test_large_values_stay_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.standard_normal(3) * 1e7).tolist()) for i in range(40)]
    got = whitening.whiten(frame(spark, rows)).toPandas()
    x = np.array([[floor(1024 * c) + 100000 for c in v] for _, v in rows], object)
    want = [int(((40 * r - x.sum(0)) ** 2).sum()) for r in x]
    want = [w if w < 1 << 63 else None for w in want]
    have = got[got["component"] == 1].sort_values("vec_id")["deviation"]
    assert [None if np.isnan(h) else h for h in have] == want
    assert got["identity_error"].max() < 1e-9


def test_empty_table(spark):
    assert whitening.whiten(frame(spark, [])).collect() == []


def test_inertia_counts_signs():
    rng = np.random.default_rng(3)
    for size in (1, 2, 5, 30):
        for _ in range(20):
            half = rng.standard_normal((size, size))
            matrix = half + half.T
            if size > 4:
                np.fill_diagonal(matrix, 0)
            values = np.linalg.eigvalsh(matrix)
            for shift in (0.0, float(rng.standard_normal()), float(values.mean())):
                assert inertia(matrix, shift) == ((values > shift).sum(), (values < shift).sum())
    assert inertia(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == (1, 1)
    assert inertia(np.zeros((3, 3)), 0.0) == (0, 0)


@pytest.mark.parametrize("spread", ["apart", "close", "equal", "pairs", "low rank"])
def test_leading_pairs(spread):
    rng = np.random.default_rng(4)
    size = 40
    basis = np.linalg.qr(rng.standard_normal((size, size)))[0]
    values = {"apart": np.arange(size, 0, -1.0), "close": 1 + 1e-9 * np.arange(size, 0, -1.0),
              "equal": np.ones(size), "pairs": np.repeat(np.arange(size // 2, 0, -1.0), 2),
              "low rank": np.r_[3.0, 2.0, np.zeros(size - 2)]}[spread]
    matrix = basis * values @ basis.T
    matrix = (matrix + matrix.T) / 2
    found, axes = leading(matrix, 8)
    assert np.allclose(found, values[:8], atol=1e-11 * values[0])
    assert np.allclose(axes.T @ axes, np.eye(8), atol=1e-12)
    assert np.abs(matrix @ axes - axes * found).max() < 1e-10 * values[0]
    slicer = Slicer(matrix)
    for k, value in enumerate(found, 1):
        assert slicer.above(value + 1e-9) <= k - 1 and slicer.above(value - 1e-9) >= k
