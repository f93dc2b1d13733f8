import math

import pytest
from pyspark.sql import functions as F

from skein.operators import impute, windows
from skein.sources import fixtures as fx
from skein.spec import PanelSpec, clean_numeric
from conftest import SF_SMALL, hours

SPEC = PanelSpec(features=("x",))


def _rows(df, cols):
    return [tuple(r[c] for c in cols) for r in df.orderBy("id").collect()]


def test_ffill_then_bfill_with_gaps_all_null_and_null_market(panel):
    t = hours(6)
    df = panel([
        (0, "A", t[0], 1.0, None), (1, "A", t[1], 2.0, 5.0), (2, "A", t[2], 3.0, None),
        (3, "A", t[3], 4.0, 7.0), (4, "A", t[4], 5.0, None),
        (10, "B", t[0], 1.0, None), (11, "B", t[1], 1.0, None),
        (20, None, t[0], 1.0, 3.0),
    ])
    out = impute.impute_missing(df, SPEC, "ffill", strategy="plain")
    got = dict(_rows(out, ["id", "x"]))
    assert [got[i] for i in range(5)] == [5.0, 5.0, 5.0, 7.0, 7.0]
    assert got[10] is None and got[11] is None          # all-null market stays null
    assert got[20] is None                              # null market: no series


def test_nan_becomes_null_at_source(panel):
    df = panel([(0, "A", hours(1)[0], float("nan"), float("nan"))])
    row = clean_numeric(df, ["target", "x"]).first()
    assert row["target"] is None and row["x"] is None


def test_ties_are_ordered_by_id_and_one_row_market(panel):
    t = hours(1)[0]
    df = panel([(2, "A", t, 20.0, 0.0), (1, "A", t, 10.0, 0.0), (3, "A", t, 30.0, 0.0), (9, "Z", t, 1.0, 0.0)])
    out = windows.window_features(df, SPEC, lags={"target": [1]}, rolling={"target": [2]}, strategy="plain")
    got = {r["id"]: r for r in out.collect()}
    assert got[1]["target_lag_1h"] is None and got[2]["target_lag_1h"] == 10.0 and got[3]["target_lag_1h"] == 20.0
    assert got[9]["target_lag_1h"] is None and got[9]["target_roll_std_2h"] is None
    assert got[3]["target_roll_mean_2h"] == 15.0
    assert got[2]["target_roll_std_2h"] is None  # one value -> sample std undefined


@pytest.mark.parametrize("bucket_rows", [37, 200])
def test_bucketed_windows_equal_plain(spark, bucket_rows):
    p = fx.hourly_events_panel(spark, SF_SMALL)
    kw = dict(lags={"target": [1, 2, 24], "wind_speed_10m": [3]}, rolling={"target": [6, 24]}, diffs=["target"])
    a = windows.window_features(p, fx.P1_SPEC, strategy="plain", **kw)
    b = windows.window_features(p, fx.P1_SPEC, strategy="bucketed", bucket_rows=bucket_rows, **kw)
    cols = [c for c in a.columns if c != "delivery_end"]
    ra, rb = _rows(a, cols), _rows(b, cols)
    assert len(ra) == len(rb)
    for x, y in zip(ra, rb):
        for u, v in zip(x, y):
            assert (u is None and v is None) or (u == v) or (
                isinstance(u, float) and math.isclose(u, v, rel_tol=1e-12, abs_tol=1e-9))


def test_bucketed_ffill_equals_plain(spark):
    p = fx.hourly_events_panel(spark, SF_SMALL)
    a = impute.impute_missing(p, fx.P1_SPEC, "ffill", strategy="plain")
    b = impute.impute_missing(p, fx.P1_SPEC, "ffill", strategy="bucketed", bucket_rows=50)
    cols = ["id", *fx.P1_FEATURES]
    assert _rows(a, cols) == _rows(b, cols)


def test_ffill_is_idempotent(spark):
    p = impute.impute_missing(fx.hourly_events_panel(spark, SF_SMALL), fx.P1_SPEC, "ffill", strategy="plain")
    q = impute.impute_missing(p, fx.P1_SPEC, "ffill", strategy="plain")
    cols = ["id", *fx.P1_FEATURES]
    assert _rows(p, cols) == _rows(q, cols)


def test_row_position_no_gaps_and_no_single_partition_exchange(spark):
    p = fx.orders_panel(spark, SF_SMALL)
    pos = windows.row_position(p, fx.P2_SPEC, order="panel")
    vals = sorted(r["row_pos"] for r in pos.select("row_pos").collect())
    assert vals == list(range(p.count()))
    plan = pos._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_engineered_features_use_one_market_exchange(spark):
    from skein.functions import features as feat
    p = fx.hourly_events_panel(spark, SF_SMALL)
    df = feat.engineer_features(p, fx.P1_SPEC, squared=["wind_speed_10m"], interactions=[("wind_forecast", "wind_speed_10m")],
                                strategy="plain")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") >= 1
    phys = df._jdf.queryExecution().executedPlan().toString()
    assert phys.count("hashpartitioning(market") <= 2  # the window exchange (+ the join inside the fixture)


def test_unknown_imputation_and_window_strategy_raise(panel):
    df = panel([(0, "A", hours(1)[0], 1.0, None)])
    with pytest.raises(ValueError):
        impute.impute_missing(df, SPEC, "mean")
    with pytest.raises(ValueError):
        windows.window_features(df, SPEC, lags={"x": [1]}, strategy="nope")


def test_bucketed_equals_plain_with_tied_times(spark):
    p = fx.orders_panel(spark, SF_SMALL)  # many orders share a date: order is (time, id)
    kw = dict(lags={"target": [1, 7]}, rolling={"target": [3]})
    a = windows.window_features(p, fx.P2_SPEC, strategy="plain", **kw)
    b = windows.window_features(p, fx.P2_SPEC, strategy="bucketed", bucket_rows=40, **kw)
    cols = ["id", "target_lag_1h", "target_lag_7h", "target_roll_mean_3h"]
    assert _rows(a, cols) == _rows(b, cols)


def test_auto_strategy_switches_to_buckets_for_a_hot_market(spark):
    p = fx.hourly_events_panel(spark, SF_SMALL)
    kw = dict(lags={"target": [1, 24]}, rolling={"target": [6]})
    plain = windows.window_features(p, fx.P1_SPEC, strategy="plain", **kw)
    spark.conf.set("skein.window.bucketRows", "100")  # every market (720 rows) is now "hot"
    try:
        assert windows.choose_strategy(p, fx.P1_SPEC)[0] == "bucketed"
        auto = windows.window_features(p, fx.P1_SPEC, **kw)
        assert "_bucket" in auto._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("skein.window.bucketRows")
    assert windows.choose_strategy(p, fx.P1_SPEC)[0] == "plain"
    cols = ["id", "target_lag_1h", "target_lag_24h", "target_roll_mean_6h"]
    assert _rows(plain, cols) == _rows(auto, cols)
