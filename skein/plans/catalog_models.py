"""Registered queries for fits, selection, SVR and time-series operators.

Fits with one or two features have exact SQL oracles (``regr_*`` aggregates and
Cramer's rule on population covariances); k-feature fits, iterative solvers and
forests are checked against numpy in pytest and rows-only by the driver.
Coefficients are rounded to 4 decimals on both sides.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from skein.operators import encode, impute, linear, relational as rel, select, svr, tseries, windows
from skein.plans.catalog import P1, P2, P1F, P2F, W, _p1l, query, r4
from skein.plans import flows
from skein.plans.oracle_sql import qr_coefs, rnd, with_p1, with_p2, with_vol
from skein.sources import fixtures as fx
from skein.spec import ARX_LAG_HOURS, ROLLING_WINDOWS

X1C, X2C = "load_forecast", "wind_forecast"
_TR = "p2_train"


def _train(spark, sf):
    return fx.orders_train_test(spark, sf)[0]


def _coef_rounded(df):
    return df.select(*[c for c in df.columns if c != "coef"], r4("coef").alias("coef"))


# -- L1 / L2 / L3 / L4 / L12 ------------------------------------------------------

_ONE = f"target IS NOT NULL AND {X1C} IS NOT NULL"
_TWO = f"target IS NOT NULL AND {X1C} IS NOT NULL AND {X2C} IS NOT NULL"


@query("l1_ols_one_feature", with_p2(
    f"SELECT market, 'const' AS feature, {rnd(f'regr_intercept(target, {X1C})')} AS coef, count(*) AS n_obs"
    f" FROM {_TR} WHERE {_ONE} GROUP BY market UNION ALL "
    f"SELECT market, '{X1C}' AS feature, {rnd(f'regr_slope(target, {X1C})')} AS coef, count(*) AS n_obs"
    f" FROM {_TR} WHERE {_ONE} GROUP BY market"))
def l1_ols_one_feature(spark, sf):
    return _coef_rounded(linear.fit_ols(_train(spark, sf), ["market"], [X1C], "target"))


def _cramer_ctes(ridge_alpha: float | None) -> str:
    """Per-market 2-feature (ridge) regression by Cramer's rule on population covariances."""
    pen = "" if ridge_alpha is None else f" + {ridge_alpha} / n"
    base = (f"SELECT market, count(*) AS n, var_pop({X1C}) AS a11, covar_pop({X1C}, {X2C}) AS a12,"
            f" var_pop({X2C}) AS a22, covar_pop({X1C}, target) AS b1, covar_pop({X2C}, target) AS b2,"
            f" avg({X1C}) AS m1, avg({X2C}) AS m2, avg(target) AS my FROM {_TR} WHERE {_TWO} GROUP BY market")
    solve = (f"SELECT market, n, (b1 * (a22{pen}) - a12 * b2) / ((a11{pen}) * (a22{pen}) - a12 * a12) AS c1,"
             f" ((a11{pen}) * b2 - a12 * b1) / ((a11{pen}) * (a22{pen}) - a12 * a12) AS c2, m1, m2, my FROM mom")
    return f"mom AS ({base}), sol AS ({solve})"


def _cramer_sql(ridge_alpha: float | None) -> str:
    body = (f"SELECT market, 'const' AS feature, {rnd('my - c1 * m1 - c2 * m2')} AS coef, n AS n_obs FROM sol"
            f" UNION ALL SELECT market, '{X1C}', {rnd('c1')}, n FROM sol"
            f" UNION ALL SELECT market, '{X2C}', {rnd('c2')}, n FROM sol")
    return with_p2(body, extra=_cramer_ctes(ridge_alpha))


@query("l1_ols_two_features", _cramer_sql(None))
def l1_ols_two_features(spark, sf):
    return _coef_rounded(linear.fit_ols(_train(spark, sf), ["market"], [X1C, X2C], "target"))


def _qr(with_panel, *args, **kw):
    ctes, body = qr_coefs(*args, **kw)
    return with_panel(body, extra=ctes)


@query("l1_ols_k_features", _qr(with_p2, _TR, P2F))
def l1_ols_k_features(spark, sf):
    return _coef_rounded(linear.fit_ols(_train(spark, sf), ["market"], P2F, "target"))


@query("l2_ols_inference", with_p2(
    f"SELECT market, {rnd('regr_r2(target, load_forecast)')} AS r2,"
    f" {rnd('sqrt((regr_syy(target, load_forecast) - regr_slope(target, load_forecast) * regr_sxy(target, load_forecast))'
            ' / (count(*) - 2) / regr_sxx(target, load_forecast))')} AS se_slope,"
    f" {rnd('regr_slope(target, load_forecast) / sqrt((regr_syy(target, load_forecast) - regr_slope(target, load_forecast)'
            ' * regr_sxy(target, load_forecast)) / (count(*) - 2) / regr_sxx(target, load_forecast))')} AS t_slope,"
    f" count(*) AS n_obs FROM {_TR} WHERE {_ONE} GROUP BY market"))
def l2_ols_inference(spark, sf):
    s = linear.ols_summary(_train(spark, sf), ["market"], [X1C], "target").where(F.col("feature") == X1C)
    return s.select("market", r4("r2").alias("r2"), r4("se").alias("se_slope"), r4("t").alias("t_slope"), "n_obs")


@query("l2_ols_summary_k")
def l2_ols_summary_k(spark, sf):
    return linear.ols_summary(_train(spark, sf), ["market"], P2F, "target")


_RESIDUALS = (
    f"fit AS (SELECT market, regr_intercept(target, {X1C}) AS c0, regr_slope(target, {X1C}) AS c1 FROM {_TR} WHERE {_ONE}"
    f" GROUP BY market), res AS (SELECT t.market, t.delivery_start, t.id, t.target - f.c0 - f.c1 * t.{X1C} AS e"
    f" FROM (SELECT * FROM {_TR} WHERE {_ONE}) t JOIN fit f ON t.market = f.market),"
    " steps AS (SELECT market, e, e - lag(e) OVER (PARTITION BY market ORDER BY delivery_start, id) AS d FROM res),"
    " centred AS (SELECT market, e, d, e - avg(e) OVER (PARTITION BY market) AS z FROM steps),"
    " mom AS (SELECT market, count(*) AS n_obs, sum(d * d) / sum(e * e) AS dw, avg(z * z) AS m2, avg(z * z * z) AS m3,"
    " avg(z * z * z * z) AS m4 FROM centred GROUP BY market),"
    " jb AS (SELECT market, n_obs, dw, m3 / (m2 * sqrt(m2)) AS skew, m4 / (m2 * m2) AS kurtosis FROM mom)")


@query("l2_residual_tests", with_p2(
    f"SELECT market, n_obs, {rnd('dw')} AS durbin_watson, {rnd('skew')} AS skew, {rnd('kurtosis')} AS kurtosis,"
    " floor(n_obs / 6.0 * (skew * skew + (kurtosis - 3) * (kurtosis - 3) / 4) * 100 + 0.5) / 100 AS jarque_bera FROM jb",
    extra=_RESIDUALS))
def l2_residual_tests(spark, sf):
    t = linear.residual_tests(_train(spark, sf), ["market"], [X1C], "target", ["delivery_start", "id"])
    return t.select("market", "n_obs", r4("durbin_watson").alias("durbin_watson"), r4("skew").alias("skew"),
                    r4("kurtosis").alias("kurtosis"), (F.floor(F.col("jarque_bera") * 100 + 0.5) / 100).alias("jarque_bera"))


def _l3_sql(grouped: bool) -> str:
    if grouped:
        coefs = (f"SELECT market, {rnd(f'regr_intercept(target, {X1C})')} AS c0, {rnd(f'regr_slope(target, {X1C})')} AS c1"
                 f" FROM {_TR} WHERE {_ONE} GROUP BY market")
        body = (f"SELECT t.id, t.market, CASE WHEN c.market IS NOT NULL THEN c.c0 + coalesce(t.{X1C}, 0.0) * c.c1 END"
                " AS pred FROM p2_test t LEFT JOIN cf c ON t.market = c.market")
    else:
        coefs = (f"SELECT {rnd(f'regr_intercept(target, {X1C})')} AS c0, {rnd(f'regr_slope(target, {X1C})')} AS c1"
                 f" FROM {_TR} WHERE {_ONE}")
        body = f"SELECT t.id, t.market, c.c0 + coalesce(t.{X1C}, 0.0) * c.c1 AS pred FROM p2_test t, cf c"
    return with_p2(body, extra=f"cf AS ({coefs})")


@query("l3_score_named_coefs", _l3_sql(True))
def l3_score_named_coefs(spark, sf):
    train, test = fx.orders_train_test(spark, sf)
    coefs = _coef_rounded(linear.fit_ols(train, ["market"], [X1C], "target"))
    return linear.score_linear(test, coefs, ["market"], [X1C]).select("id", "market", "pred")


@query("l3_unmodelled_report", with_p2(
    f"SELECT market, count(*) AS n_rows FROM p2_test WHERE market NOT IN (SELECT market FROM {_TR} WHERE {_ONE}"
    " AND market = '1-URGENT') GROUP BY market"))
def l3_unmodelled_report(spark, sf):
    """Markets of the test rows without a model (here: models fitted on the 1-URGENT market only)."""
    train, test = fx.orders_train_test(spark, sf)
    coefs = linear.fit_ols(train.where(F.col("market") == "1-URGENT"), ["market"], [X1C], "target")
    return linear.unmodelled_report(test, coefs, ["market"])


@query("l4_ridge_two_features", _cramer_sql(1.0))
def l4_ridge_two_features(spark, sf):
    return _coef_rounded(linear.fit_ridge(_train(spark, sf), ["market"], [X1C, X2C], "target", alpha=1.0))


@query("l4_ridge_k_features", _qr(with_p2, _TR, P2F, alpha=1.0))
def l4_ridge_k_features(spark, sf):
    return _coef_rounded(linear.fit_ridge(_train(spark, sf), ["market"], P2F, "target", alpha=1.0))


#: The markets of the order panel, for SQL that writes a dummy for each.
_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _pooled_sql():
    dummies = [f"market_{v}" for v in _PRIORITIES]
    ctes, body = qr_coefs("pooled", [*P2F, *[f'"{d}"' for d in dummies]], key="0", alpha=1.0)
    source = "pooled AS (SELECT *, " + ", ".join(
        f"CASE WHEN market = '{v}' THEN 1.0 ELSE 0.0 END AS \"{d}\"" for v, d in zip(_PRIORITIES, dummies)) + f" FROM {_TR})"
    return with_p2(body.replace("\"", ""), extra=f"{source},\n{ctes}")


@query("l5_pooled_ridge", _pooled_sql())
def l5_pooled_ridge(spark, sf):
    return _coef_rounded(linear.fit_ridge_pooled(_train(spark, sf), "market", P2F, "target", alpha=1.0))


def _arx_frame(spark, sf):
    p = impute.impute_missing(fx.hourly_events_panel(spark, sf), P1, "ffill")
    return flows.arx_features(rel.drop_null_rows(p, ["target"]), P1, missing="skip")


def _arx_sql():
    from skein.plans.catalog import _DOW, _ffill_sql, _flag_sql
    cols = ["id", "market", "target", "CAST(hour(delivery_start) AS INTEGER) AS hour",
            f"CAST({_DOW} AS INTEGER) AS day_of_week", "CAST(month(delivery_start) AS INTEGER) AS month",
            _flag_sql(f"{_DOW} >= 5") + " AS is_weekend"]
    cols += [f"lag(target, {n}) OVER ({W}) AS target_lag_{n}h" for n in ARX_LAG_HOURS]
    for k in ROLLING_WINDOWS:
        cols.append(f"avg(target) OVER ({W} ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING) AS target_roll_mean_{k}h")
        cols.append(rnd(f"stddev_samp(target) OVER ({W} ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)")
                    + f" AS target_roll_std_{k}h")
    cols += ["wind_speed_10m * wind_speed_10m AS wind_speed_10m_sq", "solar_forecast * solar_forecast AS solar_forecast_sq",
             "wind_forecast * wind_speed_10m AS wind_forecast_x_wind_speed_10m"]
    imputed = ("p1i AS (SELECT id, market, delivery_start, delivery_end, target, "
               + ", ".join(_ffill_sql(c) for c in P1F) + " FROM p1), "
               "p1il AS (SELECT * FROM p1i WHERE target IS NOT NULL)")
    return with_p1("SELECT " + ", ".join(cols) + " FROM p1il", extra=imputed)


@query("l6_arx_features", _arx_sql())
def l6_arx_features(spark, sf):
    df = _arx_frame(spark, sf)
    keep = ["id", "market", "target", "hour", "day_of_week", "month", "is_weekend",
            *[f"target_lag_{n}h" for n in ARX_LAG_HOURS]]
    for k in ROLLING_WINDOWS:
        keep += [f"target_roll_mean_{k}h", f"target_roll_std_{k}h"]
    keep += ["wind_speed_10m_sq", "solar_forecast_sq", "wind_forecast_x_wind_speed_10m"]
    std = {f"target_roll_std_{k}h" for k in ROLLING_WINDOWS}
    return df.select(*[r4(c).alias(c) if c in std else F.col(c) for c in keep])


@query("l7_exog_ridge_predictions", with_p2(
    "SELECT t.id, t.market, CASE WHEN s.market IS NOT NULL THEN floor(s.my - s.c1 * s.m1 - s.c2 * s.m2"
    f" + coalesce(t.{X1C}, 0.0) * s.c1 + coalesce(t.{X2C}, 0.0) * s.c2 + 0.5) END AS pred"
    " FROM p2_test t LEFT JOIN sol s ON t.market = s.market", extra=_cramer_ctes(1.0)))
def l7_exog_ridge_predictions(spark, sf):
    train, test = fx.orders_train_test(spark, sf)
    preds, _, _ = linear.fit_predict_exog(train, test, "market", [X1C, X2C], "target", 1.0)
    return preds.select("id", "market", F.floor(F.col("pred") + 0.5).cast("double").alias("pred"))


@query("l12_score_pooled", _l3_sql(False))
def l12_score_pooled(spark, sf):
    train, test = fx.orders_train_test(spark, sf)
    coefs = _coef_rounded(linear.fit_ols(train, [], [X1C], "target"))
    return linear.score_linear(test, coefs, [], [X1C]).select("id", "market", "pred")


# -- L8-L11 -------------------------------------------------------------------------

def _scaled_train(spark, sf):
    train = _train(spark, sf).dropna(subset=[*P2F, "target"])
    _, scaled, _, _ = encode.scale_features(train, None, None, P2F)
    return scaled


@query("l8_linear_svr")
def l8_linear_svr(spark, sf):
    return svr.train_linear_svr(_scaled_train(spark, sf), P2F, "target", alpha=1e-4, epsilon=0.1,
                                order_cols=["delivery_start", "id"])


_L9_GRID = {"alpha": [1e-5, 1e-4, 1e-3], "epsilon": [0.01, 0.1, 0.5],
            "learning_rate": ["invscaling", "adaptive"], "eta0": [0.001, 0.01]}


@query("l9_grid_search")
def l9_grid_search(spark, sf):
    return svr.grid_search(_scaled_train(spark, sf), P2F, "target", _L9_GRID, n_splits=3,
                           order_cols=["delivery_start", "market", "id"])[1]


@query("l9_fold_assignment", with_p2(
    "SELECT id, pos, CASE WHEN pos >= n - 3 * s THEN CAST(floor((pos - (n - 3 * s)) / s) AS INTEGER) END AS test_fold"
    " FROM (SELECT id, row_number() OVER (ORDER BY delivery_start, market, id) - 1 AS pos,"
    " count(*) OVER () AS n, count(*) OVER () // 4 AS s FROM p2_train)"))
def l9_fold_assignment(spark, sf):
    train = _train(spark, sf)
    ranked = windows.row_position(train, P2, order="time", name="pos")
    n = train.count()
    folds = svr.time_series_folds(n, 3)
    fold = None
    for i, (_, (lo, hi)) in enumerate(folds):
        cond = (F.col("pos") >= lo) & (F.col("pos") < hi)
        fold = F.when(cond, F.lit(i)) if fold is None else fold.when(cond, F.lit(i))
    return ranked.select("id", "pos", fold.cast("int").alias("test_fold"))


@query("l10_rbf_svr")
def l10_rbf_svr(spark, sf):
    return svr.train_rbf_svr(_scaled_train(spark, sf), P2F, "target", C=10.0, epsilon=0.1, n_components=50,
                             order_cols=["delivery_start", "id"])[0]


@query("l10_kernel_grid_search")
def l10_kernel_grid_search(spark, sf):
    """The whole default grid: 36 candidates x 3 folds."""
    return svr.kernel_grid_search(_scaled_train(spark, sf), P2F, "target", n_splits=3,
                                  order_cols=["delivery_start", "market", "id"])[2]


@query("l11_train_evaluate")
def l11_train_evaluate(spark, sf):
    train = _train(spark, sf).dropna(subset=[*P2F, "target"])
    tr, va = rel.temporal_split(train, P2, val_months=3)
    _, trs, vas, _ = encode.scale_features(tr, va, None, P2F)
    return svr.train_and_evaluate(trs, vas, P2F, "target", method="sgd")[2]


@query("l11_train_evaluate_kernel")
def l11_train_evaluate_kernel(spark, sf):
    train = _train(spark, sf).dropna(subset=[*P2F, "target"])
    tr, va = rel.temporal_split(train, P2, val_months=3)
    _, trs, vas, _ = encode.scale_features(tr, va, None, P2F)
    return svr.train_and_evaluate(trs, vas, P2F, "target", method="svr")[2]


# -- X ------------------------------------------------------------------------------

def _correlation_filter_sql(feats, threshold=0.05, inter=0.95):
    """The scan over pairs of the list, one CTE for each row of it; s{i} tells whether feature i still stands."""
    n = len(feats)
    first = [f"abs(corr({f}, target)) AS a{i}" for i, f in enumerate(feats)]
    first += [f"coalesce(abs(corr({feats[i]}, {feats[j]})) > {inter}, false) AS c{i}_{j}" for i in range(n) for j in range(i + 1, n)]
    ctes = ["x0 AS (SELECT " + ", ".join(first) + " FROM p2)",
            "x1 AS (SELECT *, " + ", ".join(f"coalesce(a{i} >= {threshold}, false) AS s{i}" for i in range(n)) + " FROM x0)"]
    for i in range(n - 1):
        later = range(i + 1, n)
        beaten = " OR ".join(f"(c{i}_{j} AND s{j} AND a{j} > a{i})" for j in later)
        change = [f"(s{i} AND NOT ({beaten})) AS s{i}"] + [f"(s{j} AND NOT (s{i} AND c{i}_{j} AND a{j} <= a{i})) AS s{j}" for j in later]
        ctes.append(f"x{i + 2} AS (SELECT * REPLACE ({', '.join(change)}) FROM x{i + 1})")
    body = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CASE WHEN a{i} IS NULL OR isnan(a{i}) THEN 'undefined' WHEN a{i} < {threshold} THEN 'weak'"
        f" WHEN s{i} THEN 'kept' ELSE 'collinear' END AS status, {rnd(f'a{i}')} AS abs_corr_target FROM x{n}"
        for i, f in enumerate(feats))
    return with_p2(body, extra=", ".join(ctes))


#: Thresholds under which the order panel has weak, collinear and kept features.
_LOOSE = (0.02, 0.6)


@query("x1_correlation_filter", _correlation_filter_sql(["id", *P2F]))
def x1_correlation_filter(spark, sf):
    out = select.correlation_filter_table(fx.orders_panel(spark, sf), "target", 0.05, 0.95, cols=["id", "target", *P2F])
    return out.withColumn("abs_corr_target", r4("abs_corr_target"))


@query("x1_correlation_filter_loose", _correlation_filter_sql(["id", *P2F], *_LOOSE))
def x1_correlation_filter_loose(spark, sf):
    out = select.correlation_filter_table(fx.orders_panel(spark, sf), "target", *_LOOSE, cols=["id", "target", *P2F])
    return out.withColumn("abs_corr_target", r4("abs_corr_target"))


@query("x2_vif_two", with_p2(
    "SELECT f AS feature, " + rnd("1.0 / (1.0 - sxy * sxy / (sxx * syy))") + " AS vif FROM"
    f" (SELECT sum({X1C} * {X2C}) AS sxy, sum({X1C} * {X1C}) AS sxx, sum({X2C} * {X2C}) AS syy"
    f" FROM p2 WHERE {X1C} IS NOT NULL AND {X2C} IS NOT NULL) s,"
    f" (SELECT '{X1C}' AS f UNION ALL SELECT '{X2C}') n"))
def x2_vif_two(spark, sf):
    v = select.vif_table(fx.orders_panel(spark, sf), [X1C, X2C])
    return v.select("feature", r4("vif").alias("vif"))


@query("x2_vif_filter")
def x2_vif_filter(spark, sf):
    kept = select.vif_filter(fx.orders_panel(spark, sf), P2F, 10.0)
    return spark.createDataFrame([(f,) for f in kept], "feature string")


@query("x3_rf_importance")
def x3_rf_importance(spark, sf):
    return select.rf_importance(_train(spark, sf), P2F, "target", n_estimators=200, max_depth=12, seed=42)


@query("x4_lasso_cv")
def x4_lasso_cv(spark, sf):
    return select.lasso_cv(_train(spark, sf), P2F, "target", order_cols=["market", "delivery_start", "id"])[1]


# -- T ------------------------------------------------------------------------------

def _series(spark, sf):
    p = impute.impute_missing(fx.hourly_events_panel(spark, sf), P1, "ffill")
    return rel.drop_null_rows(p, ["target"])


@query("t1_adf_lag0", with_p1(
    "SELECT market, " + rnd("regr_slope(dy, ylag) / sqrt((regr_syy(dy, ylag) - regr_slope(dy, ylag) * regr_sxy(dy, ylag))"
                            " / (count(*) - 2) / regr_sxx(dy, ylag))") + " AS adf_stat, 0 AS used_lag, count(*) AS n_obs"
    f" FROM (SELECT market, target - lag(target, 1) OVER ({W}) AS dy, lag(target, 1) OVER ({W}) AS ylag FROM p1l)"
    " WHERE dy IS NOT NULL GROUP BY market", extra="p1l AS (SELECT * FROM p1 WHERE target IS NOT NULL)"))
def t1_adf_lag0(spark, sf):
    a = tseries.adf_by_market(_p1l(spark, sf), P1, "target", fixed_lag=0)
    return a.select("market", r4("adf_stat").alias("adf_stat"), "used_lag", "n_obs")


@query("t2_adf_by_market")
def t2_adf_by_market(spark, sf):
    return tseries.adf_by_market(_series(spark, sf), P1, "target")


@query("t3_difference_if_needed")
def t3_difference_if_needed(spark, sf):
    return tseries.difference_if_needed(_series(spark, sf), P1, "target")


@query("t4_lag_order")
def t4_lag_order(spark, sf):
    return tseries.select_lag_order(_series(spark, sf), P1, ["target", "load_forecast"], maxlags=24)


def _varx(spark, sf):
    s = _series(spark, sf)
    return tseries.fit_varx(s, P1, ["target"], ["solar_forecast", "wind_forecast", "load_forecast"], order=24)


_VARX_EXOG = ["solar_forecast", "wind_forecast", "load_forecast"]


def _varx_ctes(order: int, rows: str) -> tuple[str, str]:
    """The filled series, its lags over ``rows`` and the regression of each market on lags and exogenous columns."""
    from skein.plans.catalog import _ffill_sql
    lags = [f"target_lag_{n}h" for n in range(1, order + 1)]
    ctes, body = qr_coefs("lagged", [*lags, *_VARX_EXOG])
    return (f"filled AS (SELECT id, market, delivery_start, target, {', '.join(_ffill_sql(c) for c in _VARX_EXOG)} FROM p1),"
            " s AS MATERIALIZED (SELECT * FROM filled WHERE target IS NOT NULL),"
            " cut AS (SELECT max(delivery_start) - INTERVAL 48 HOUR AS limit_time FROM s),"
            f" history AS MATERIALIZED ({rows}), lagged AS (SELECT *, "
            + ", ".join(f"lag(target, {n}) OVER ({W}) AS {c}" for n, c in enumerate(lags, 1)) + f" FROM history),\n{ctes}"), body


def _varx_fit_sql():
    ctes, body = _varx_ctes(24, "SELECT * FROM s")
    return with_p1(f"SELECT market, 'target' AS equation, feature AS regressor, coef FROM ({body})", extra=ctes)


def _forecast_sql(order: int = 24, steps: int = 48):
    """The fit on the history, then one forecast after the other in a recursive query that carries the last values."""
    ctes, _ = _varx_ctes(order, "SELECT * FROM s WHERE delivery_start <= (SELECT limit_time FROM cut)")
    exog = "".join(f" + coalesce({c}, 0.0) * w{order + i}" for i, c in enumerate(_VARX_EXOG))
    ctes += (f", horizon AS MATERIALIZED (SELECT f.*, o.w_const{exog} AS base FROM (SELECT *, row_number() OVER ({W}) AS step"
             " FROM s WHERE delivery_start > (SELECT limit_time FROM cut)) f JOIN qr_out o ON f.market = o.k),"
             f" seed AS (SELECT market, list_slice(list(target ORDER BY delivery_start DESC, id DESC), 1, {order}) AS state"
             " FROM history GROUP BY market),"
             f" ar AS (SELECT k AS market, [{', '.join(f'w{i}' for i in range(order))}] AS ar FROM qr_out),"
             " walk AS (SELECT market, CAST(0 AS BIGINT) AS step, state, CAST(NULL AS DOUBLE) AS forecast FROM seed UNION ALL"
             f" SELECT market, step, list_prepend(forecast, list_slice(state, 1, {order - 1})), forecast FROM"
             " (SELECT w.market, h.step, w.state, h.base + list_dot_product(ar.ar, w.state) AS forecast FROM walk w"
             " JOIN horizon h ON h.market = w.market AND h.step = w.step + 1 JOIN ar ON ar.market = w.market"
             f" WHERE h.step <= {steps}) n)")
    sql = with_p1("SELECT h.market, h.id, h.delivery_start, CAST(h.step AS INTEGER) AS step, " + rnd("w.forecast") + " AS forecast"
                  " FROM walk w JOIN horizon h ON h.market = w.market AND h.step = w.step", extra=ctes)
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


@query("t5_varx_fit", _varx_fit_sql())
def t5_varx_fit(spark, sf):
    return _coef_rounded(_varx(spark, sf)[0])


@query("t5_varx_models")
def t5_varx_models(spark, sf):
    return _varx(spark, sf)[1]


def _last_hours(spark, sf, **horizon):
    """Fit on all but the last 48 hours of each market, forecast those 48 hours."""
    s = _series(spark, sf)
    cut = s.agg(F.max("delivery_start")).first()[0]
    from datetime import timedelta
    hist = s.where(F.col("delivery_start") <= F.lit(cut - timedelta(hours=48)))
    fut = s.where(F.col("delivery_start") > F.lit(cut - timedelta(hours=48)))
    coefs, _ = tseries.fit_varx(hist, P1, ["target"], ["solar_forecast", "wind_forecast", "load_forecast"], order=24)
    out = tseries.forecast_varx(hist, fut, coefs, P1, ["target"], ["solar_forecast", "wind_forecast", "load_forecast"],
                                order=24, **horizon)
    return out.withColumn("forecast", r4("forecast"))


@query("t6_forecast", _forecast_sql())
def t6_forecast(spark, sf):
    return _last_hours(spark, sf, steps=48)


@query("t6_forecast_blocks", _forecast_sql())
def t6_forecast_blocks(spark, sf):
    """The horizon in blocks, as for one without a bound."""
    return _last_hours(spark, sf)


# -- Volume: order-free operators over every lineitem row ---------------------------

@query("v1_lineitem_ridge_by_market", _qr(with_vol, "vol", fx.VOLUME_FEATURES, alpha=1.0))
def v1_lineitem_ridge_by_market(spark, sf):
    """L4 over the line-item panel: one Gram pass over all rows, 6 markets, 5 features."""
    return _coef_rounded(linear.fit_ridge(fx.lineitem_panel(spark, sf), ["market"], list(fx.VOLUME_FEATURES), "target", 1.0))


def _vol_describe_sql():
    from skein.plans.oracle_sql import with_vol
    cols = ["target", *fx.VOLUME_FEATURES]
    return with_vol(
        "SELECT column_name, count(value) AS count, avg(value) AS mean, " + rnd("stddev_samp(value)") + " AS std,"
        " min(value) AS min, quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50,"
        " quantile_cont(value, 0.75) AS p75, max(value) AS max FROM ("
        + " UNION ALL ".join(f"SELECT '{c}' AS column_name, {c} AS value FROM vol WHERE {c} IS NOT NULL" for c in cols)
        + ") GROUP BY column_name")


@query("v2_lineitem_describe", _vol_describe_sql())
def v2_lineitem_describe(spark, sf):
    """A4 over every line item: moments plus exact quartiles from range-partitioned ranks."""
    from skein.operators import stats
    d = stats.describe(fx.lineitem_panel(spark, sf), ["target", *fx.VOLUME_FEATURES])
    return d.select("column_name", "count", "mean", r4("std").alias("std"), "min", "p25", "p50", "p75", "max")


def _two_series_sql(order: int = 24, steps: int = 48):
    """As ``_forecast_sql`` for two series: two regressions on both series' lags, a state of pairs."""
    from skein.plans.catalog import _ffill_sql
    lags = [(c, n) for n in range(1, order + 1) for c in ("target", "load_forecast")]
    names = [f"{c}_lag_{n}h" for c, n in lags] + ["solar_forecast"]
    fits = [qr_coefs("lagged", names, target=t, prefix=p)[0] for t, p in (("target", "fit_t"), ("load_forecast", "fit_l"))]
    ar = [f"[{', '.join(f'{p}.w{i}' for i in range(2 * order))}]" for p in ("t", "l")]
    ctes = (f"filled AS (SELECT id, market, delivery_start, target, {_ffill_sql('solar_forecast')}, {_ffill_sql('load_forecast')}"
            " FROM p1), s AS MATERIALIZED (SELECT * FROM filled WHERE target IS NOT NULL AND load_forecast IS NOT NULL),"
            " cut AS (SELECT max(delivery_start) - INTERVAL 48 HOUR AS limit_time FROM s),"
            " history AS MATERIALIZED (SELECT * FROM s WHERE delivery_start <= (SELECT limit_time FROM cut)),"
            " lagged AS MATERIALIZED (SELECT *, " + ", ".join(f"lag({c}, {n}) OVER ({W}) AS {c}_lag_{n}h" for c, n in lags)
            + " FROM history), " + ", ".join(fits)
            + f", model AS MATERIALIZED (SELECT t.k AS market, t.w_const AS ct, l.w_const AS cl, t.w{2 * order} AS bt,"
              f" l.w{2 * order} AS bl, {ar[0]} AS art, {ar[1]} AS arl FROM fit_t_out t JOIN fit_l_out l ON t.k = l.k),"
              f" horizon AS MATERIALIZED (SELECT *, row_number() OVER ({W}) AS step FROM s"
              " WHERE delivery_start > (SELECT limit_time FROM cut)),"
              " seed AS (SELECT market, flatten(list_slice(list([target, load_forecast] ORDER BY delivery_start DESC, id DESC),"
              f" 1, {order})) AS state FROM history GROUP BY market),"
              " walk AS (SELECT market, CAST(0 AS BIGINT) AS step, state, CAST(NULL AS DOUBLE) AS ft, CAST(NULL AS DOUBLE) AS fl"
              f" FROM seed UNION ALL SELECT market, step, list_concat([ft, fl], list_slice(state, 1, {2 * order - 2})), ft, fl FROM"
              " (SELECT w.market, h.step, w.state,"
              " m.ct + m.bt * coalesce(h.solar_forecast, 0.0) + list_dot_product(m.art, w.state) AS ft,"
              " m.cl + m.bl * coalesce(h.solar_forecast, 0.0) + list_dot_product(m.arl, w.state) AS fl FROM walk w"
              " JOIN horizon h ON h.market = w.market AND h.step = w.step + 1 JOIN model m ON m.market = w.market"
              f" WHERE h.step <= {steps}) n)")
    sql = with_p1("SELECT h.market, h.id, h.delivery_start, CAST(h.step AS INTEGER) AS step, " + rnd("w.ft")
                  + " AS forecast_target, " + rnd("w.fl") + " AS forecast_load_forecast"
                  " FROM walk w JOIN horizon h ON h.market = w.market AND h.step = w.step", extra=ctes)
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


@query("t6_forecast_varx_two_series", _two_series_sql())
def t6_forecast_varx_two_series(spark, sf):
    """VARX(24) on (target, load_forecast) with solar_forecast as exogenous; forecast the last 48 hours."""
    from datetime import timedelta
    s = _series(spark, sf)
    cut = s.agg(F.max("delivery_start")).first()[0]
    hist = s.where(F.col("delivery_start") <= F.lit(cut - timedelta(hours=48)))
    fut = s.where(F.col("delivery_start") > F.lit(cut - timedelta(hours=48)))
    endog, exog = ["target", "load_forecast"], ["solar_forecast"]
    coefs, _ = tseries.fit_varx(hist, P1, endog, exog, order=24)
    out = tseries.forecast_varx(hist, fut, coefs, P1, endog, exog, order=24, steps=48)
    return out.withColumns({f"forecast_{e}": r4(f"forecast_{e}") for e in endog})
