import numpy as np
import pytest

from cinelens.operators import factorize


def _long(spark, a):
    data = [(i, f"t{j}", float(a[i, j])) for i in range(a.shape[0]) for j in range(a.shape[1]) if a[i, j] != 0]
    w = spark.createDataFrame(data, "movieId long, term string, weight double")
    movies = spark.createDataFrame([(i,) for i in range(a.shape[0])], "movieId long")
    return w, movies


def test_randomized_svd_full_rank_keeps_inner_products(spark):
    rng = np.random.default_rng(1)
    a = rng.random((30, 12)) * (rng.random((30, 12)) < 0.4)
    w, movies = _long(spark, a)
    items, basis, sv = factorize.randomized_svd(w, movies, 12, power_iters=2)
    x = np.stack([np.array(r.vec) for r in items.orderBy("movieId").collect()])
    assert np.allclose(x @ x.T, a @ a.T, atol=1e-9)
    assert np.allclose(sv[: np.linalg.matrix_rank(a)], np.linalg.svd(a, compute_uv=False)[: np.linalg.matrix_rank(a)])
    # The term basis projects a row back to its item vector.
    v = {r.term: np.array(r.vec) for r in basis.collect()}
    proj = sum(a[0, j] * v[f"t{j}"] for j in range(12) if a[0, j] != 0)
    assert np.allclose(proj, x[0], atol=1e-9)


def test_randomized_svd_truncated_and_low_rank(spark):
    rng = np.random.default_rng(2)
    low = rng.random((25, 3)) @ rng.random((3, 15))  # rank 3
    w, movies = _long(spark, low)
    items, _, sv = factorize.randomized_svd(w, movies, 5, power_iters=3)
    x = np.stack([np.array(r.vec) for r in items.orderBy("movieId").collect()])
    assert x.shape == (25, 5)
    assert np.allclose(x[:, 3:], 0.0)  # Q17: zero-padded past the rank
    assert np.allclose(x @ x.T, low @ low.T, atol=1e-8)
    with pytest.raises(ValueError):
        factorize.randomized_svd(w, movies, 16)


def test_products_with_weights_of_either_sign(spark):
    """Positive weights go through vectors, others through arrays; both sum
    weight times row."""
    import numpy as np

    from cinelens.operators.factorize import _Sides

    rng = np.random.default_rng(8)
    x = rng.normal(size=(5, 4))
    rows = spark.createDataFrame([(f"t{i}", r.tolist()) for i, r in enumerate(x)], "term string, vec array<double>")
    for low in (0.1, -1.0):
        a = rng.uniform(low, 1.0, size=(6, 5))
        a[2:, 3] = 0.1
        table = spark.createDataFrame([(i, f"t{j}", float(a[i, j])) for i in range(6) for j in range(5)], "movieId long, term string, weight double")
        sides = _Sides(table, 6, 5, low > 0)
        got = {r["movieId"]: r["vec"] for r in sides.times(rows, "term", "movieId", 4).collect()}
        sides.release()
        assert np.allclose([got[i] for i in range(6)], a @ x, atol=1e-12)
