import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.functions import features as feat
from skein.operators import encode, evaluate, stats
from skein.spec import PanelSpec
from skein.sources import fixtures as fx
from conftest import SF_SMALL, hours

SPEC = PanelSpec(features=("x",))


def test_calendar_dummies_weekend_and_prime(panel):
    t = hours(24 * 9)  # 2024-01-01 is a Monday
    df = panel([(i, "A", ts, 0.0, 0.0) for i, ts in enumerate(t)] + [(999, "A", None, 0.0, 0.0)])
    out = feat.add_time_prime_dummies(feat.add_weekend_dummy(feat.add_time_dummies(
        feat.add_temporal_features(df, SPEC), SPEC), SPEC), SPEC)
    rows = {r["id"]: r for r in out.collect()}
    assert rows[0]["day_of_week"] == 0 and rows[0]["hour_0"] == 1 and rows[0]["month_1"] == 1
    assert rows[24 * 5]["is_weekend"] == 1 and rows[24 * 5]["isWeekend"] == 1 and rows[24 * 4]["isWeekend"] == 0
    assert rows[7]["JANUARY_PrimeMorning"] == 1 and rows[17]["JANUARY_PrimeNight"] == 1 and rows[12]["JANUARY_PrimeMorning"] == 0
    assert rows[999]["isWeekend"] == 0 and rows[999]["hour_3"] == 0 and rows[999]["is_weekend"] == 0
    mh = feat.add_month_hour_dummies(df, SPEC)
    names = [c for c in mh.columns if c.endswith("h") and "_" in c]
    assert len(names) == 287 and "JANUARY_0h" not in names and names[0] == "JANUARY_1h"


def test_squares_missing_rules(panel):
    df = panel([(0, "A", hours(1)[0], 1.0, 3.0)])
    with pytest.raises(KeyError):
        feat.add_squared_features(df, ["x", "absent"], missing="error")
    out = feat.add_squared_features(df, ["x", "absent"], missing="skip").first()
    assert out["x_sq"] == 9.0 and "absent_sq" not in out.asDict()


def test_clip_keeps_null(panel):
    df = panel([(0, "A", hours(1)[0], 500.0, None), (1, "A", hours(1)[0], -500.0, 1.0)])
    out = feat.add_clipped(feat.add_clipped(df, "target"), "x").orderBy("id").collect()
    assert out[0]["target_clipped"] == 200.0 and out[1]["target_clipped"] == -100.0 and out[0]["x_clipped"] is None


def test_exact_group_quantiles_match_numpy(spark):
    p = fx.orders_panel(spark, SF_SMALL)
    q = stats.group_quantiles(p, ["market"], ["target", "wind_forecast"], [0.1, 0.25, 0.5, 0.9]).collect()
    pdf = p.toPandas()
    for r in q:
        vals = pdf[pdf.market == r["market"]][r["column_name"]].dropna().to_numpy()
        assert math.isclose(r["value"], float(np.percentile(vals, r["prob"] * 100)), rel_tol=1e-12)


def test_histogram_counts_and_constant_column(panel):
    df = panel([(i, "A", hours(1)[0], float(i % 7), 1.0) for i in range(50)])
    h = stats.histogram(df, "target", 10).orderBy("bin").collect()
    assert sum(r["count"] for r in h) == 50 and len(h) == 10 and h[-1]["count"] > 0
    c = stats.histogram(df, "x", 100).where(F.col("count") > 0).collect()
    assert len(c) == 1 and c[0]["bin"] == 50


def test_metrics_and_r2_rules(panel, spark):
    rng = np.random.default_rng(1)
    y, p = rng.normal(size=200), rng.normal(size=200)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "target double, pred double")
    m = evaluate.evaluate(df)
    assert math.isclose(m["MAE"], np.mean(np.abs(y - p)), rel_tol=1e-12)
    assert math.isclose(m["RMSE"], np.sqrt(np.mean((y - p) ** 2)), rel_tol=1e-12)
    assert math.isclose(m["MAPE"], np.mean(np.abs(y - p) / (np.abs(y) + 1e-8)) * 100, rel_tol=1e-10)
    assert math.isclose(m["R2"], 1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2), rel_tol=1e-10)
    const = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0)], "target double, pred double")
    assert evaluate.evaluate(const)["R2"] == 1.0
    one = spark.createDataFrame([(1.0, 2.0)], "target double, pred double")
    assert evaluate.evaluate(one)["R2"] is None
    with pytest.raises(ValueError):
        evaluate.evaluate(spark.createDataFrame([(1.0, None)], "target double, pred double"))


def test_scaler_population_std_and_zero_std(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    sc = {r["column"]: r for r in encode.fit_scaler(df, ["a", "b"]).collect()}
    assert sc["a"]["scale"] == 1.0 and sc["a"]["mean"] == 2.0 and sc["b"]["scale"] == 1.0
    out = encode.apply_scaler(df, encode.fit_scaler(df, ["a", "b"])).collect()
    assert [r["a"] for r in out] == [-1.0, 1.0] and [r["b"] for r in out] == [0.0, 0.0]


def test_onehot_fixed_categories_and_label(spark):
    train = spark.createDataFrame([("b",), ("a",)], "market string")
    test = spark.createDataFrame([("a",), ("c",), (None,)], "market string")
    cats = encode.fit_categories(train, "market")
    out = encode.one_hot(test, "market", cats).collect()
    assert [(r["market_a"], r["market_b"]) for r in out] == [(1, 0), (0, 0), (0, 0)]
    lab = encode.label_encode(test, "market", cats).collect()
    assert [r["market_label"] for r in lab] == [0, None, None]
