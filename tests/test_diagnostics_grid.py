import math

import numpy as np
import pytest

from skein.operators import linear, svr, tseries


def test_residual_tests_equal_numpy(spark):
    rng = np.random.default_rng(3)
    rows = []
    for g, n in (("hot", 3000), ("b", 40), (None, 25), ("two", 2)):
        e = np.cumsum(rng.normal(size=n)) * 0.2 + rng.exponential(size=n)
        x = rng.normal(size=n)
        rows += [(g, i, float(x[i]), float(2 + 3 * x[i] + e[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "grp string, t long, x double, target double").repartition(7)
    got = {r.grp: r for r in linear.residual_tests(df.where("grp is not null"), ["grp"], ["x"], "target", ["t"]).collect()}
    for g in ("hot", "b"):
        part = sorted((r for r in rows if r[0] == g), key=lambda r: r[1])
        x, y = np.array([r[2] for r in part]), np.array([r[3] for r in part])
        X = np.column_stack([np.ones_like(x), x])
        e = y - X @ np.linalg.lstsq(X, y, rcond=None)[0]
        z = e - e.mean()
        s, k = (z ** 3).mean() / (z ** 2).mean() ** 1.5, (z ** 4).mean() / (z ** 2).mean() ** 2
        jb = len(e) / 6 * (s * s + (k - 3) ** 2 / 4)
        assert got[g].durbin_watson == pytest.approx((np.diff(e) ** 2).sum() / (e ** 2).sum(), rel=1e-9)
        assert (got[g].skew, got[g].kurtosis, got[g].jarque_bera) == pytest.approx((s, k, jb), rel=1e-7)
        assert got[g].jb_p_value == pytest.approx(math.exp(-jb / 2), rel=1e-6, abs=1e-300)
        assert got[g].n_obs == len(e)
    one = linear.residual_tests(df.where("grp = 'b'"), [], ["x"], "target", ["t"]).collect()
    assert len(one) == 1 and one[0].durbin_watson == pytest.approx(got["b"].durbin_watson)


def test_nested_factor_gives_every_order():
    rng = np.random.default_rng(4)
    X = rng.normal(size=(60, 7))
    X[:, 4] = X[:, 1] - 2 * X[:, 2]  # explained by the ones before
    y = X @ rng.normal(size=7) + rng.normal(size=60)
    Z = np.column_stack([X, y])
    C = np.cov(Z.T, bias=True) * 60
    factor = tseries.nested_factor(C, 7)
    for p in range(7):
        A = np.column_stack([np.ones(60), X[:, :p + 1]])
        sse = ((y - A @ np.linalg.lstsq(A, y, rcond=None)[0]) ** 2).sum()
        assert C[-1, -1] - (factor[-1, :p + 1] ** 2).sum() == pytest.approx(sse, rel=1e-8)


def test_many_markets_are_solved_in_tasks(spark):
    """More markets than the driver once took."""
    df = spark.range(21_000 * 12).selectExpr(
        "id", "cast(id div 12 as string) market", "cast(timestamp_seconds((id % 12) * 3600) as timestamp_ntz) delivery_start",
        "cast(pmod(hash(id), 1000) as double) target")
    out = tseries.adf_by_market(df, col="target", fixed_lag=0, strategy="plain")
    assert out.count() == 21_000 and out.where("adf_stat is null").count() == 0


def grid_frame(spark, n=240):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, 2))
    y = np.sin(2 * x[:, 0]) + 0.5 * x[:, 1] ** 2 + rng.normal(scale=0.05, size=n)
    return spark.createDataFrame([(i, float(a), float(b), float(c)) for i, ((a, b), c) in enumerate(zip(x, y))],
                                 "id long, a double, b double, target double"), x, y


def test_kernel_grid(spark):
    df, _, _ = grid_frame(spark)
    grid = {"kernel": ["rbf", "linear"], "C": [1, 100], "epsilon": [0.01], "gamma": ["scale", 0.2]}
    coefs, fmap, cv = svr.kernel_grid_search(df, ["a", "b"], param_grid=grid, order_cols=["id"], n_components=60, max_iter=25)
    rows = cv.collect()
    assert len(rows) == 8 and {r.rank for r in rows} >= {1}
    best = min(rows, key=lambda r: r["rank"])
    assert best.kernel == "rbf" and fmap is not None and coefs.count() == 61  # a curve: no line fits it
    linear_rows = [r for r in rows if r.kernel == "linear" and r.C == 1]
    assert len({r.mean_mae for r in linear_rows}) == 1  # gamma does not move a linear kernel
    for bad in ({"alpha": [1.0]}, {"kernel": ["poly"]}):
        with pytest.raises(ValueError):
            svr.kernel_grid_search(df, ["a", "b"], param_grid=bad)
    with pytest.raises(ValueError):
        svr.grid_search(df, ["a", "b"], param_grid={"C": [1.0]})


def test_random_features_against_the_exact_kernel():
    """The same solver on the exact kernel's own features (500 rows) and on random ones."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(500, 2))
    y = np.sin(2 * x[:, 0]) + 0.5 * x[:, 1] ** 2 + rng.normal(scale=0.05, size=500)
    gamma = 0.25
    K = np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(2))
    w, V = np.linalg.eigh(K)
    exact = V * np.sqrt(np.maximum(w, 0))

    def solve(Z, alpha=1.0 / (10.0 * 500), eps=0.1):
        Z1 = np.column_stack([np.ones(500), Z])
        theta = np.zeros(Z1.shape[1])
        D = np.eye(len(theta))
        D[0, 0] = 0
        for step in range(60):
            r = y - Z1 @ theta
            out = np.abs(r) > eps
            u = np.where(out, 1 / np.maximum(np.abs(r) - eps, 1e-9), 0.5 / np.maximum(eps - np.abs(r), 1e-9)) if step else np.ones(500)
            c = np.where(out, eps * np.sign(r), r) if step else 0.0
            theta = np.linalg.lstsq((Z1 * u[:, None]).T @ Z1 / 500 + alpha * D, Z1.T @ (u * (y - c)) / 500, rcond=None)[0]
        return Z1 @ theta

    want = solve(exact)
    error = {}
    for d in (100, 400):
        fmap = svr.RandomFourierMap(2, d, gamma)
        Z = fmap(x)
        assert np.abs(Z @ Z.T - K).mean() < 1.0 / math.sqrt(d)
        error[d] = np.abs(solve(Z) - want).mean() / y.std()
    # measured: 0.11 and 0.04 standard deviations of the target
    assert error[400] < error[100] < 0.15 and error[400] < 0.06, error
