"""End-to-end flows composed from the operators (the four original workflows).

* ``flow_arx``    (B) per-market ARX Ridge: validation metrics, pooled comparison, exog-only test predictions.
* ``flow_svr``    (A) pooled linear SVR: forest ranking -> threshold -> scaling -> grid search -> predictions.
* ``flow_ols``    (C) per-market OLS on month / prime-hour dummies, weekend flag and squares -> predictions.
* ``flow_ensemble`` (D) mean and inverse-MAE blends of two prediction sets.

Column names come from a ``PanelSpec``. A flow's fixed feature list may name columns that a panel lacks: that is an error,
unless the caller allows it with ``missing='skip'``; the features used are in the returned tables either way. Predictions
always carry their row id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions import features as feat
from skein.operators import encode, ensemble, evaluate, impute, linear, relational as rel, select, svr, windows
from skein.session import ensure_checkpoint_dir
from skein.sources import fixtures as fx
from skein.spec import (AR_FEATURES, ARX_LAG_HOURS, DROP_COLS, EXOG_FEATURES, INTERACTIONS, MONTH_NAMES,
                        ROLLING_WINDOWS, SQUARED_COLS, VAR_SQ, PanelSpec)


def _present(df: DataFrame, cols, missing: str = "error") -> list[str]:
    """``cols``, without those that ``df`` lacks where ``missing`` is 'skip'; else they are an error."""
    if missing not in ("error", "skip"):
        raise ValueError(f"Unknown treatment of missing columns: {missing}")
    have = set(df.columns)
    absent = [c for c in cols if c not in have]
    if absent and missing == "error":
        raise KeyError(f"columns not found: {absent}")
    return [c for c in cols if c in have]


def _pairs_present(df: DataFrame, pairs, missing: str = "error"):
    have = set(_present(df, dict.fromkeys(c for pair in pairs for c in pair), missing))
    return [(a, b) for a, b in pairs if a in have and b in have]


# -- B ------------------------------------------------------------------------

def arx_features(df: DataFrame, spec: PanelSpec, missing: str = "error") -> DataFrame:
    """Flow-B features: temporal, target lags (8), rolling mean/std (3), squares, interactions."""
    out = feat.add_temporal_features(df, spec)
    out = windows.window_features(out, spec, lags={spec.target: ARX_LAG_HOURS},
                                  rolling={spec.target: ROLLING_WINDOWS})
    out = feat.add_squared_features(out, _present(out, SQUARED_COLS, missing))
    return feat.add_interaction_features(out, _pairs_present(out, INTERACTIONS, missing))


def flow_arx(train_raw: DataFrame, test_raw: DataFrame, spec: PanelSpec, val_months: int = 3,
             alpha: float = 1.0, pooled: bool = True, test_predictions: bool = True, missing: str = "error") -> dict:
    """Flow B. Returns a dict of DataFrames: val_predictions, metrics, metrics_by_market, coefficients and,
    when asked, pooled_metrics, test_predictions (id, target), unmodelled (test markets
    without a model).

    The engineered training frame feeds several passes (split cutoff, moments, Gram,
    scoring), so it is checkpointed once to the cluster's checkpoint directory.
    """
    train = impute.impute_missing(train_raw, spec, "ffill")
    train = rel.drop_null_rows(train, [spec.target])
    ensure_checkpoint_dir(train.sparkSession)
    eng = arx_features(train, spec, missing).checkpoint(eager=True)
    exog = _present(eng, EXOG_FEATURES, missing)
    feats = _present(eng, AR_FEATURES, missing) + exog
    tr, va = rel.temporal_split(eng, spec, val_months)
    tr, va = rel.drop_null_rows(tr, feats), rel.drop_null_rows(va, feats)
    coefs = linear.fit_ridge(tr, [spec.market], feats, spec.target, alpha)
    val_pred = linear.score_linear(va, coefs, [spec.market], feats)
    scored = val_pred.where(F.col("pred").isNotNull())
    out = {
        "val_predictions": scored.select(spec.id, spec.market, spec.target, "pred"),
        "metrics": evaluate.metrics(val_pred, spec.target, "pred"),
        "metrics_by_market": evaluate.metrics_by_market(val_pred, spec.target, "pred", spec.market),
        "coefficients": coefs,
    }
    if pooled:
        pooled_coefs = linear.fit_ridge_pooled(tr, spec.market, feats, spec.target, alpha)
        pooled_pred = linear.score_pooled(va, pooled_coefs, spec.market, feats)
        out["pooled_metrics"] = evaluate.metrics(pooled_pred, spec.target, "pred")
    if not test_predictions:
        return out
    # Test: exogenous-only models per market on all training rows (no target lags exist there).
    test = impute.impute_missing(test_raw, spec, "ffill")
    test_eng = feat.add_temporal_features(test, spec)
    test_eng = feat.add_squared_features(test_eng, _present(test_eng, SQUARED_COLS, missing))
    test_eng = feat.add_interaction_features(test_eng, _pairs_present(test_eng, INTERACTIONS, missing))
    test_eng = rel.fill_zero(test_eng, exog)
    full = rel.drop_null_rows(eng, exog)
    preds, _, unmodelled = linear.fit_predict_exog(full, test_eng, spec.market, exog, spec.target, alpha,
                                                   spec.id)
    out["test_predictions"] = preds.select(spec.id, F.col("pred").alias("target"))
    out["unmodelled"] = unmodelled
    return out


# -- A ------------------------------------------------------------------------

def flow_svr(train_raw: DataFrame, test_raw: DataFrame, spec: PanelSpec, rf_trees: int = 200,
             rf_depth: int = 12, importance_threshold: float = 0.005, param_grid: dict | None = None,
             n_splits: int = 3, order: str = "panel", missing: str = "error") -> dict:
    """Flow A. Returns importances, cv table, coefficients and test predictions (id, target).

    ``order``: rows of the cross-validation folds, 'panel' (market by market, as the rows of a panel lie) or 'time' (all
    markets by time). No feature at or above ``importance_threshold`` is an error.
    """
    fold_order = {"panel": [spec.market, spec.time, spec.id], "time": [spec.time, spec.market, spec.id]}[order]
    train = rel.drop_null_rows(impute.impute_missing(train_raw, spec, "ffill"), [spec.target])
    test = impute.impute_missing(test_raw, spec, "ffill")
    sq = _present(train, SQUARED_COLS, missing)
    ix = _pairs_present(train, INTERACTIONS, missing)
    tr = feat.engineer_features(train, spec, squared=sq, interactions=ix)
    te = feat.engineer_features(test, spec, include_lags=False, include_rolling=False, squared=sq, interactions=ix)
    cats = encode.fit_categories(train, spec.market)  # the same rows, without their windows
    tr, te = encode.one_hot(tr, spec.market, cats), encode.one_hot(te, spec.market, cats)
    excluded = {spec.id, spec.target, spec.market, spec.time, spec.end}
    test_cols = set(te.columns)
    feats = [c for c in tr.columns if c not in excluded and c in test_cols]
    ensure_checkpoint_dir(tr.sparkSession)
    tr = rel.drop_null_rows(tr, feats).checkpoint(eager=True)
    imp = select.rf_importance(tr, feats, spec.target, n_estimators=rf_trees, max_depth=rf_depth)
    important = [r["feature"] for r in rel.above(imp, "importance", importance_threshold).collect()]
    if not important:
        raise ValueError(f"no feature has an importance above {importance_threshold}")
    te = rel.fill_zero(te, important)
    scaler, tr_s, _, te_s = encode.scale_features(tr, None, te, important)
    grid = param_grid or {"alpha": [1e-5, 1e-4, 1e-3], "epsilon": [0.01, 0.1, 0.5],
                          "learning_rate": ["invscaling", "adaptive"], "eta0": [0.001, 0.01]}
    coefs, cv = svr.grid_search(tr_s, important, spec.target, grid, n_splits,
                                order_cols=fold_order)
    preds = linear.score_linear(te_s, coefs, [], important)
    return {"importances": imp, "cv": cv, "coefficients": coefs,
            "test_predictions": preds.select(spec.id, F.col("pred").alias("target"))}


# -- C ------------------------------------------------------------------------

def ols_design(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Flow-C design: month + prime-hour dummies, weekend flag, squares (missing skipped)."""
    out = feat.add_time_prime_dummies(df, spec)
    out = feat.add_weekend_dummy(out, spec)
    return feat.add_squared_features(out, VAR_SQ, missing="skip")


def calendar_indicators(df: DataFrame) -> list[str]:
    """The 0/1 calendar columns of ``ols_design``: functions of month, prime hours and weekend, 72 combinations at most."""
    names = {*MONTH_NAMES, "isWeekend", *(f"{m}_{part}" for m in MONTH_NAMES for part in ("PrimeMorning", "PrimeNight"))}
    return [c for c in df.columns if c in names]


def flow_ols(train_raw: DataFrame, test_raw: DataFrame, spec: PanelSpec, include_id: bool = True,
             class_sums: bool = False) -> dict:
    """Flow C: every column but market/target/times is a regressor (``id`` too, as the
    original workflow does; ``include_id=False`` leaves it out). Returns coefficients and test
    predictions (id, target) - a market without a model gets NULL.

    ``class_sums``: sum the calendar columns by their combinations, so that the data pass reads the numeric columns only;
    the same coefficients up to rounding."""
    tr, te = ols_design(train_raw, spec), ols_design(test_raw, spec)
    drop = set(DROP_COLS) | {spec.market, spec.target, spec.time, spec.end}
    if not include_id:
        drop.add(spec.id)
    regs = [c for c in tr.columns if c not in drop]
    coefs = linear.fit_ols(tr, [spec.market], regs, spec.target, const_rule=True,
                           indicators=calendar_indicators(tr) if class_sums else ())
    preds = linear.score_linear(te, coefs, [spec.market], regs)
    return {"coefficients": coefs, "test_predictions": preds.select(spec.id, F.col("pred").alias("target"))}


def validate_ols(train_raw: DataFrame, spec: PanelSpec, val_months: int = 3, include_id: bool = True) -> DataFrame:
    """Flow C on a temporal split: fitted on all but the last ``val_months`` months, metrics of those months."""
    known = rel.drop_null_rows(train_raw, [spec.target])
    tr, va = rel.temporal_split(known, spec, val_months)
    preds = flow_ols(tr, va, spec, include_id)["test_predictions"].withColumnRenamed(spec.target, "pred")
    return evaluate.metrics(va.select(spec.id, spec.target).join(preds, spec.id), spec.target, "pred")


# -- D ------------------------------------------------------------------------

def flow_ensemble(a: DataFrame, b: DataFrame, mae_a: float, mae_b: float, id_col: str = "id") -> dict:
    """Flow D: align on id (report one-sided ids), mean blend and inverse-MAE blend."""
    aligned = rel.align_predictions(a, b, id_col, "target")
    preds = {"a": a, "b": b}
    return {
        "alignment": rel.alignment_report(aligned),
        "mean": ensemble.mean_ensemble(preds, id_col, "target"),
        "weighted": ensemble.weighted_ensemble(preds, ensemble.inverse_mae_weights({"a": mae_a, "b": mae_b}),
                                               id_col, "target"),
    }


# -- flagship -------------------------------------------------------------------

def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders panel -> ffill -> ARX features -> temporal split -> per-market Ridge -> per-market metrics."""
    train, test = fx.orders_train_test(spark, sf_dir)
    return flow_arx(train, test, fx.P2_SPEC, pooled=False, test_predictions=False, missing="skip")["metrics_by_market"]
