"""Registered end-to-end flows (rows-only checks: they chain fits whose parts have oracles).

The order panel lacks some columns of the fixed feature lists, so its flows allow ``missing='skip'``."""

from __future__ import annotations

from skein.operators.gram import written
from skein.plans import flows
from skein.plans.catalog import query
from skein.sources import fixtures as fx


def _panels(spark, sf):
    """The order panels, read from a table below the checkpoint folder: the flows read them several times, the join runs
    once."""
    return fx.split_orders(written(fx.orders_panel(spark, sf)))


def _b(spark, sf, **kw):
    train, test = _panels(spark, sf)
    return flows.flow_arx(train, test, fx.P2_SPEC, missing="skip", **kw)


@query("flow_b_arx_metrics_by_market")
def flow_b_arx_metrics_by_market(spark, sf):
    return _b(spark, sf, pooled=False, test_predictions=False)["metrics_by_market"]


@query("flow_b_arx_pooled_metrics")
def flow_b_arx_pooled_metrics(spark, sf):
    return _b(spark, sf, test_predictions=False)["pooled_metrics"]


@query("flow_b_arx_test_predictions")
def flow_b_arx_test_predictions(spark, sf):
    return _b(spark, sf, pooled=False)["test_predictions"]


@query("flow_a_svr_test_predictions")
def flow_a_svr_test_predictions(spark, sf):
    train, test = _panels(spark, sf)
    return flows.flow_svr(train, test, fx.P2_SPEC, missing="skip")["test_predictions"]


@query("flow_c_ols_test_predictions")
def flow_c_ols_test_predictions(spark, sf):
    train, test = fx.orders_train_test(spark, sf)
    return flows.flow_ols(train, test, fx.P2_SPEC)["test_predictions"]


@query("flow_d_ensemble")
def flow_d_ensemble(spark, sf):
    """Blend of the flow-B and flow-C predictions, weighted by the inverse MAE of both models on the same last months."""
    train, test = _panels(spark, sf)
    b = flows.flow_arx(train, test, fx.P2_SPEC, pooled=False, missing="skip")
    c = flows.flow_ols(train, test, fx.P2_SPEC)
    mae_b = b["metrics"].first()["mae"]
    mae_c = flows.validate_ols(train, fx.P2_SPEC).first()["mae"]
    out = flows.flow_ensemble(b["test_predictions"], c["test_predictions"], mae_b, mae_c)
    return out["weighted"]
