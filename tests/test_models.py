import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.operators import linear, select, svr, tseries
from skein.operators.distributions import t_two_sided_p
from skein.sources import fixtures as fx
from skein.spec import PanelSpec
from conftest import SF_SMALL, hours

P2F = list(fx.P2_FEATURES)


def _coefs(df, key="market"):
    out = {}
    for r in df.collect():
        out.setdefault(r[key] if key else None, {})[r["feature"]] = r["coef"]
    return out


def _train_pdf(spark):
    tr = fx.orders_train_test(spark, SF_SMALL)[0]
    return tr, tr.dropna(subset=[*P2F, "target"]).toPandas()


def test_ols_and_ridge_k_features_match_numpy(spark):
    tr, pdf = _train_pdf(spark)
    ols = _coefs(linear.fit_ols(tr, ["market"], P2F, "target"))
    rdg = _coefs(linear.fit_ridge(tr, ["market"], P2F, "target", 1.0))
    for m, g in pdf.groupby("market"):
        X, y = g[P2F].to_numpy(), g["target"].to_numpy()
        b = np.linalg.lstsq(np.c_[np.ones(len(g)), X], y, rcond=None)[0]
        got = [ols[m]["const"]] + [ols[m][f] for f in P2F]
        assert np.allclose(got, b, rtol=1e-7, atol=1e-6 * np.abs(b).max())
        Xc, yc = X - X.mean(0), y - y.mean()
        br = np.linalg.solve(Xc.T @ Xc + np.eye(len(P2F)), Xc.T @ yc)
        assert np.allclose([rdg[m][f] for f in P2F], br, rtol=1e-7, atol=1e-6 * np.abs(br).max())


def test_ols_summary_se_t_and_p(spark):
    tr, pdf = _train_pdf(spark)
    s = linear.ols_summary(tr, ["market"], ["load_forecast"], "target").where(F.col("feature") == "load_forecast")
    rows = {r["market"]: r for r in s.collect()}
    for m, g in pdf.groupby("market"):
        x, y = g["load_forecast"].to_numpy(), g["target"].to_numpy()
        X = np.c_[np.ones(len(x)), x]
        b = np.linalg.lstsq(X, y, rcond=None)[0]
        e = y - X @ b
        sigma2 = e @ e / (len(x) - 2)
        se = math.sqrt(sigma2 * np.linalg.inv(X.T @ X)[1, 1])
        assert math.isclose(rows[m]["se"], se, rel_tol=1e-7)
        assert math.isclose(rows[m]["t"], b[1] / se, rel_tol=1e-7)
        r2 = 1 - e @ e / np.sum((y - y.mean()) ** 2)
        assert math.isclose(rows[m]["r2"], r2, rel_tol=1e-7, abs_tol=1e-12)
    assert math.isclose(t_two_sided_p(2.0, 10), 0.0733880, abs_tol=1e-6)
    assert math.isclose(t_two_sided_p(1.96, 1e7), 0.0499958, abs_tol=1e-5)


def test_const_rule_collinear_and_constant_columns(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=60)
    rows = [(i, "A", float(x[i]), float(2 * x[i]), 3.0, float(1 + 2 * x[i] + rng.normal() * 0.1)) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, market string, a double, b double, c double, target double")
    c = _coefs(linear.fit_ols(df, ["market"], ["a", "b", "c"], "target"))["A"]
    assert "const" not in c  # the non-zero constant column carries the intercept
    X = np.c_[x, 2 * x, np.full(60, 3.0)]
    y = np.array([r[5] for r in rows])
    fitted_ref = X @ np.linalg.pinv(X) @ y
    fitted = X @ np.array([c["a"], c["b"], c["c"]])
    assert np.allclose(fitted, fitted_ref, rtol=1e-8, atol=1e-8)


def test_score_unmodelled_market_and_pooled_equals_grouped(spark):
    tr = fx.orders_train_test(spark, SF_SMALL)[0]
    one = tr.where(F.col("market") == "1-URGENT")
    g = _coefs(linear.fit_ridge(one, ["market"], P2F, "target", 1.0))["1-URGENT"]
    p = _coefs(linear.fit_ridge(one, [], P2F, "target", 1.0), key=None)[None]
    for f in ["const", *P2F]:
        assert math.isclose(g[f], p[f], rel_tol=1e-9, abs_tol=1e-9)
    coefs = linear.fit_ridge(one, ["market"], P2F, "target", 1.0)
    scored = linear.score_linear(tr, coefs, ["market"], P2F)
    other = scored.where(F.col("market") != "1-URGENT").where(F.col("pred").isNotNull()).count()
    assert other == 0
    rep = {r["market"] for r in linear.unmodelled_report(tr, coefs, ["market"]).collect()}
    assert "1-URGENT" not in rep and len(rep) == 4


def test_vif_matches_direct_regression(spark):
    tr, pdf = _train_pdf(spark)
    v = {r["feature"]: r["vif"] for r in select.vif_table(tr, P2F).collect()}
    X = pdf[P2F].to_numpy()
    for i, f in enumerate(P2F):
        o = np.delete(X, i, axis=1)
        beta = np.linalg.lstsq(o, X[:, i], rcond=None)[0]
        ssr = np.sum((X[:, i] - o @ beta) ** 2)
        assert math.isclose(v[f], np.sum(X[:, i] ** 2) / ssr, rel_tol=1e-6)


def test_correlation_filter_greedy_rule(spark):
    rng = np.random.default_rng(3)
    n = 300
    y = rng.normal(size=n)
    a = y + rng.normal(size=n) * 0.5
    b = a + rng.normal(size=n) * 0.01       # collinear with a, slightly weaker on y
    c = rng.normal(size=n)                   # weak
    d = np.full(n, 2.0)                      # constant: undefined correlation
    rows = [tuple(float(v) for v in r) for r in zip(y, a, b, c, d)]
    df = spark.createDataFrame(rows, "target double, a double, b double, c double, d double")
    kept, dropped, _ = select.correlation_filter(df, "target", 0.05, 0.95)
    ca, cb = abs(np.corrcoef(a, y)[0, 1]), abs(np.corrcoef(b, y)[0, 1])
    assert kept == (["a"] if ca >= cb else ["b"])
    assert "d" not in kept and "d" not in dropped
    assert (abs(np.corrcoef(c, y)[0, 1]) < 0.05) == ("c" in dropped)


def test_lasso_kkt_at_chosen_alpha(spark):
    tr, pdf = _train_pdf(spark)
    sel, table, alpha = select.lasso_cv(tr, P2F, "target", order_cols=["market", "delivery_start", "id"])
    w = np.array([r["coef"] for r in table.collect()])
    X, y = pdf[P2F].to_numpy(), pdf["target"].to_numpy()
    Xc, yc = X - X.mean(0), y - y.mean()
    grad = Xc.T @ (yc - Xc @ w) / len(y)
    for j in range(len(P2F)):
        if w[j] != 0:
            assert math.isclose(grad[j], alpha * np.sign(w[j]), rel_tol=1e-4, abs_tol=1e-6 * alpha)
        else:
            assert abs(grad[j]) <= alpha * (1 + 1e-4)


def test_time_series_folds_rule():
    assert svr.time_series_folds(10, 3) == [((0, 4), (4, 6)), ((0, 6), (6, 8)), ((0, 8), (8, 10))]
    assert svr.time_series_folds(11, 3)[0] == ((0, 5), (5, 7))


def test_linear_svr_objective_is_near_optimal(spark):
    rng = np.random.default_rng(7)
    X = rng.normal(size=(400, 3))
    y = X @ np.array([1.5, -2.0, 0.5]) + 3 + rng.standard_t(2, size=400)
    rows = [(i, *map(float, X[i]), float(y[i])) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, target double")
    c = {r["feature"]: r["coef"] for r in svr.train_linear_svr(df, ["a", "b", "c"], "target", 1e-4, 0.1,
                                                                  order_cols=["id"]).collect()}
    th = np.array([c["const"], c["a"], c["b"], c["c"]])

    def J(t):
        r = y - t[0] - X @ t[1:]
        return np.maximum(np.abs(r) - 0.1, 0).mean() + 0.5e-4 * np.sum(t[1:] ** 2)

    best, w = J(th), th.copy()
    for it in range(1, 5001):
        r = y - w[0] - X @ w[1:]
        g = -np.sign(r) * (np.abs(r) > 0.1)
        w = w - 0.05 / np.sqrt(it) * np.r_[g.mean(), X.T @ g / len(y) + 1e-4 * w[1:]]
        best = min(best, J(w))
    assert J(th) <= best * (1 + 1e-3)


def test_adf_decisions_and_pvalue_table(spark):
    rng = np.random.default_rng(42)
    n = 400
    walk = np.cumsum(rng.normal(size=n))
    ar = np.zeros(n)
    for i in range(1, n):
        ar[i] = 0.5 * ar[i - 1] + rng.normal()
    t = hours(n)
    rows = [(i, "walk", t[i], float(walk[i])) for i in range(n)] + [(10_000 + i, "ar", t[i], float(ar[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, market string, delivery_start timestamp_ntz, target double")
    res = {r["market"]: r for r in tseries.adf_by_market(df, PanelSpec(features=()), "target").collect()}
    assert res["walk"]["stationary"] is False and res["ar"]["stationary"] is True
    assert math.isclose(tseries.mackinnon_p(-2.86), 0.0502, abs_tol=5e-4)
    # Statistic at the chosen lag equals a numpy OLS on the same rows.
    p = res["ar"]["used_lag"]
    dy = np.diff(ar)
    Y = dy[p:]
    cols = [ar[p:-1]] + [dy[p - j:len(dy) - j] for j in range(1, p + 1)]
    X = np.c_[np.ones(len(Y)), np.column_stack(cols)]
    b = np.linalg.lstsq(X, Y, rcond=None)[0]
    e = Y - X @ b
    se = math.sqrt(e @ e / (len(Y) - X.shape[1]) * np.linalg.inv(X.T @ X)[1, 1])
    assert math.isclose(res["ar"]["adf_stat"], b[1] / se, rel_tol=1e-6)


def _gram_rows(df, k):
    from skein.operators import gram
    return {r["market"]: gram.unpack(r, k) for r in df.collect()}


def test_gram_forms_match_numpy(spark):
    """Centred, uncentred and fixed sums of one pass equal numpy's on each group's rows."""
    from skein.operators import gram
    cols = [*P2F, "target"]
    clean = fx.orders_train_test(spark, SF_SMALL)[0].dropna(subset=["market", *cols])
    k = len(cols)
    data = {m: g[cols].to_numpy(float) for m, g in clean.select("market", *cols).toPandas().groupby("market")}
    shift, scale = np.arange(k) + 0.5, np.arange(k) + 2.0
    for kind, kw in (("centred", {}), ("raw", {"center": False}), ("fixed", {"fixed": (shift, scale)})):
        got = _gram_rows(gram.grouped_gram(clean, ["market"], cols, **kw), k)
        assert set(got) == set(data)
        for m, X in data.items():
            n, mean, sc, lo, hi, s, G = got[m]
            Z = (X - {"centred": X.mean(0), "raw": 0.0, "fixed": shift}[kind]) / sc
            assert n == len(X) and np.array_equal(lo, X.min(0)) and np.array_equal(hi, X.max(0))
            assert np.allclose(s, Z.sum(0), rtol=1e-9, atol=1e-8 * n)
            assert np.allclose(G, Z.T @ Z, rtol=1e-9, atol=1e-9 * np.abs(G).max())


def test_gram_reads_each_row_once_and_flushes(spark, monkeypatch):
    """The kernel sees every row once, also where the result is read twice; a small byte budget changes nothing."""
    from pyspark.sql import functions as F
    from skein.operators import gram
    df = spark.range(0, 5000, 1, 4).select(F.concat(F.lit("m"), F.col("id") % 50).alias("market"),
                                           (F.col("id") * 1.5).alias("a"), (F.col("id") % 7).cast("double").alias("b"))
    seen = spark.sparkContext.accumulator(0)

    def counting(it):
        for pdf in it:
            seen.add(len(pdf))
            yield pdf

    counted = df.mapInPandas(counting, df.schema)
    whole = gram.grouped_gram(counted, ["market"], ["a", "b"])
    want = _gram_rows(whole, 2)
    whole.count()
    assert seen.value == 5000
    monkeypatch.setattr(gram, "FLUSH_BYTES", 300)
    small = _gram_rows(gram.grouped_gram(df, ["market"], ["a", "b"]), 2)
    assert set(small) == set(want) and len(want) == 50
    for m in want:
        assert all(np.allclose(x, y, rtol=1e-9) for x, y in zip(small[m], want[m]))


def test_ols_summary_constant_regressor_carries_the_intercept_error(spark):
    rng = np.random.default_rng(3)
    x, e = rng.normal(size=40), rng.normal(size=40)
    y = 3 + 2 * x + e
    df = spark.createDataFrame([("m", 2.0, float(a), float(b)) for a, b in zip(x, y)],
                               "market string, c double, x double, target double")
    got = {r["feature"]: r for r in linear.ols_summary(df, ["market"], ["c", "x"]).collect()}
    X = np.column_stack([np.full(40, 2.0), x])
    b = np.linalg.solve(X.T @ X, X.T @ y)
    resid = y - X @ b
    se = np.sqrt(np.diag(np.linalg.inv(X.T @ X)) * (resid @ resid) / 38)
    for name, coef, err in zip(("c", "x"), b, se):
        assert math.isclose(got[name]["coef"], coef, rel_tol=1e-8)
        assert math.isclose(got[name]["se"], err, rel_tol=1e-8)


def test_correlation_of_constant_columns_is_null(spark):
    """Also where a column is constant only on the rows it shares with the other, whatever rounding leaves."""
    from skein.operators import stats
    rows = [(0.1, float(i), None if i % 2 else 0.3) for i in range(30)] + [(None, 5.0, 0.7), (0.1, None, 0.9)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(5)
    got = {(r["f1"], r["f2"]): r["corr"] for r in stats.corr_long(df, ["a", "b", "c"]).collect()}
    assert got["a", "a"] is None and got["a", "b"] is None and got["a", "c"] is None
    assert got["b", "b"] == 1.0
    pairs = [(r[1], r[2]) for r in rows if r[1] is not None and r[2] is not None]
    assert math.isclose(got["b", "c"], np.corrcoef(*zip(*pairs))[0, 1], rel_tol=1e-9)


def test_metrics_count_incomplete_rows(spark):
    from skein.operators import evaluate
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 3.0, None), ("b", None, 1.0)],
                               "market string, target double, pred double")
    m = evaluate.metrics(df).first()
    assert (m["mae"], m["n_rows"], m["n_null"]) == (1.0, 1, 2)
    by = {r["market"]: r for r in evaluate.metrics_by_market(df).collect()}
    assert by["a"]["n_null"] == 1 and by["b"]["mae"] is None and by["b"]["n_rows"] == 0


def test_varx_forecast_two_series_matches_numpy_recursion(spark):
    from datetime import timedelta
    from skein.operators import impute, relational as rel
    s = rel.drop_null_rows(impute.impute_missing(fx.hourly_events_panel(spark, SF_SMALL), fx.P1_SPEC, "ffill"),
                           ["target"])
    cut = s.agg(F.max("delivery_start")).first()[0]
    hist = s.where(F.col("delivery_start") <= F.lit(cut - timedelta(hours=12)))
    fut = s.where(F.col("delivery_start") > F.lit(cut - timedelta(hours=12)))
    en, ex = ["target", "load_forecast"], ["solar_forecast"]
    coefs, _ = tseries.fit_varx(hist, fx.P1_SPEC, en, ex, order=3)
    out = tseries.forecast_varx(hist, fut, coefs, fx.P1_SPEC, en, ex, order=3, steps=12).toPandas()
    c = coefs.toPandas()
    for m in out.market.unique():
        cc = c[c.market == m]
        h = hist.where(F.col("market") == m).orderBy("delivery_start", "id").toPandas()
        f = fut.where(F.col("market") == m).orderBy("delivery_start", "id").toPandas().head(12)
        Y = [h[en].to_numpy()[-p] for p in range(1, 4)]
        preds = []
        for i in range(len(f)):
            yh = []
            for e in en:
                q = cc[cc.equation == e].set_index("regressor")["coef"]
                v = q["const"] + q["solar_forecast"] * f["solar_forecast"].iloc[i]
                v += sum(q[f"{e2}_lag_{p}h"] * Y[p - 1][j] for p in range(1, 4) for j, e2 in enumerate(en))
                yh.append(v)
            preds.append(yh)
            Y = [np.array(yh)] + Y[:2]
        got = out[out.market == m].sort_values("step")[["forecast_target", "forecast_load_forecast"]].to_numpy()
        assert np.allclose(np.array(preds), got, rtol=1e-9, atol=1e-6)
