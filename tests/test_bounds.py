"""Horizons, categories, calendar classes and feature lists without hidden bounds."""

from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.operators import encode, impute, linear, relational as rel, stats, tseries
from skein.operators.gram import classed_gram, grouped_gram, unpack
from skein.plans import flows
from skein.sources import fixtures as fx
from skein.spec import PanelSpec
from conftest import SF_SMALL

HOURS = 48


@pytest.fixture(scope="module")
def series(spark):
    s = rel.drop_null_rows(impute.impute_missing(fx.hourly_events_panel(spark, SF_SMALL), fx.P1_SPEC, "ffill"),
                           ["target"])
    cut = s.agg(F.max("delivery_start")).first()[0] - timedelta(hours=HOURS)
    return s.where(F.col("delivery_start") <= F.lit(cut)).cache(), s.where(F.col("delivery_start") > F.lit(cut)).cache()


@pytest.mark.parametrize("endog, block", [(["target"], 1), (["target"], 5_000), (["target", "load_forecast"], 7)])
def test_forecast_in_blocks_equals_one_fold(series, endog, block):
    hist, fut = series
    exog = ["solar_forecast"]
    coefs, _ = tseries.fit_varx(hist, fx.P1_SPEC, endog, exog, order=3)
    coefs = coefs.cache()
    names = ["forecast"] if len(endog) == 1 else [f"forecast_{e}" for e in endog]
    want = tseries.forecast_varx(hist, fut, coefs, fx.P1_SPEC, endog, exog, order=3, steps=HOURS)
    got = tseries._forecast_blocks(hist, fut, coefs, fx.P1_SPEC, endog, exog, 3, None, block)
    assert dict(got.dtypes) == dict(want.dtypes)
    a, b = (d.select("market", "id", "step", *names).orderBy("market", "step").toPandas() for d in (want, got))
    assert len(a) > HOURS and a[["market", "id", "step"]].equals(b[["market", "id", "step"]])
    assert np.allclose(a[names], b[names], rtol=1e-9, atol=1e-6)


def test_forecast_in_blocks_with_short_history_no_model_and_no_rows(spark):
    spec = PanelSpec(features=())
    day = "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, CAST(h AS INT), 0, 0)"
    rows = spark.range(30).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'a' WHEN id % 3 = 1 THEN 'b' ELSE 'c' END AS market",
                                      "id AS h").selectExpr("id", "market", f"{day} AS delivery_start", "CAST(h AS DOUBLE) AS target")
    coefs = spark.createDataFrame([("a", "target", "const", 1.0), ("a", "target", "target_lag_1h", 0.5),
                                   ("b", "target", "const", 1.0)], "market string, equation string, regressor string, coef double")
    hist = rows.where("id < 6").where("market <> 'b' OR id < 3")  # 'b' has one observation
    fut = rows.where("id >= 6")
    got = tseries._forecast_blocks(hist, fut, coefs, spec, ["target"], [], 2, 5, 2).orderBy("market", "step").collect()
    a = [r["forecast"] for r in got if r["market"] == "a"]
    y, want = 3.0, []
    for _ in range(5):
        y = 1 + 0.5 * y
        want.append(y)
    assert a == pytest.approx(want)
    assert [r["forecast"] for r in got if r["market"] == "b"] == [None] * 5
    assert {r["market"] for r in got} == {"a", "b"}
    assert tseries.forecast_varx(hist, fut.limit(0), coefs, spec, ["target"], [], 2).count() == 0


def test_a_missing_exogenous_column_is_an_error(series):
    with pytest.raises(KeyError, match="nowhere"):
        tseries.fit_varx(series[0], fx.P1_SPEC, ["target"], ["nowhere"], order=2)


def test_class_sums_give_the_dense_gram_and_fit(spark):
    train = flows.ols_design(fx.orders_train_test(spark, SF_SMALL)[0], fx.P2_SPEC)
    flags = flows.calendar_indicators(train)
    numeric = ["load_forecast", "wind_forecast", "target"]
    assert len(flags) == 11 + 24 + 1
    dense = {r["market"]: r for r in grouped_gram(train.dropna(subset=[*flags, *numeric]), ["market"], [*flags, *numeric]).collect()}
    cells = {r["market"]: r for r in classed_gram(train, ["market"], flags, numeric).collect()}
    assert set(dense) == set(cells) and len(dense) == 5
    for m in dense:
        a, b = (unpack(r, len(flags) + len(numeric)) for r in (dense[m], cells[m]))
        assert a[0] == b[0]
        for x, y in zip(a[1:5], b[1:5]):
            assert np.allclose(x, y, rtol=1e-12, atol=1e-12)
        assert np.allclose(a[6], b[6], rtol=1e-9, atol=1e-8)
    regs = [*flags, *numeric[:2]]
    one = linear.fit_ols(train, ["market"], regs)
    two = linear.fit_ols(train, ["market"], regs, indicators=flags)
    a, b = ({(r["market"], r["feature"]): r["coef"] for r in d.collect()} for d in (one, two))
    assert set(a) == set(b) and max(abs(a[k] - b[k]) for k in a) < 1e-5 * max(map(abs, a.values()))


def test_class_sums_refuse_other_values(spark):
    df = spark.createDataFrame([("a", 2, 1.0)], "market string, flag int, target double")
    with pytest.raises(Exception, match="other than 0 and 1"):
        classed_gram(df, ["market"], ["flag"], ["target"]).collect()


def test_labels_of_more_categories_than_fit_inline(spark):
    n = encode.MAX_INLINE_CATEGORIES + 500
    df = spark.range(n).selectExpr("id", "lpad(CAST(id AS STRING), 6, '0') AS market").unionByName(
        spark.createDataFrame([(n, None)], "id long, market string"))
    got = encode.label_encode(df, "market")
    assert got.columns == ["id", "market", "market_label"]
    assert got.where("market_label <> id").count() == 0 and got.where("market_label IS NULL").count() == 1
    table = encode.category_ranks(df.where("id < 5"), "market", "market_label")
    seen = encode.label_encode(df, "market", table)
    assert seen.where("market_label = id").count() == 5 and seen.count() == n + 1


def test_profile_rows_hold_the_pivot(spark):
    p = fx.orders_panel(spark, SF_SMALL)
    rows = {(r["market"], r["month"]): r["mean"] for r in stats.mean_profile(p, fx.P2_SPEC, "month").collect()}
    wide = stats.mean_pivot(p, fx.P2_SPEC, "month").collect()
    cells = {(m, r["month"]): r[m] for r in wide for m in r.asDict() if m != "month" and r[m] is not None}
    assert rows.keys() == cells.keys() and all(abs(rows[k] - cells[k]) < 1e-6 for k in rows)


def test_flows_name_the_columns_that_a_panel_lacks(spark):
    train, test = fx.orders_train_test(spark, SF_SMALL)
    with pytest.raises(KeyError, match="columns not found"):
        flows.flow_arx(train.drop("wind_forecast"), test, fx.P2_SPEC)
    with pytest.raises(KeyError):
        flows.flow_svr(train, test, fx.P2_SPEC, order="rows")
