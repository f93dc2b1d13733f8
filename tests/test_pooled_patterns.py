"""Pooled ridge without dummy columns, VIF from null patterns, readers of damaged files."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.operators import encode, linear, select
from skein.sources import fixtures as fx, panel_io
from conftest import SF_SMALL

P2F = list(fx.P2_FEATURES)


def _table(df):
    return {r["feature"]: r["coef"] for r in df.collect()}


@pytest.mark.parametrize("alpha", [0.5, 1.0, 40.0])
def test_pooled_ridge_equals_fit_with_dense_dummies(spark, alpha):
    train = fx.orders_train_test(spark, SF_SMALL)[0]
    # some rows without a market: they have no dummy
    train = train.withColumn("market", F.when(F.col("id") % 11 != 0, F.col("market")))
    cats = encode.fit_categories(train, "market")
    dense = _table(linear.fit_ridge(encode.one_hot(train, "market", cats), [], [*P2F, *[f"market_{v}" for v in cats]],
                                    "target", alpha))
    got = _table(linear.fit_ridge_pooled(train, "market", P2F, "target", alpha))
    assert got.keys() == dense.keys()
    for f, v in dense.items():
        assert got[f] == pytest.approx(v, rel=1e-8, abs=1e-6)


def test_pooled_ridge_categories_scores_and_edges(spark):
    train = fx.orders_train_test(spark, SF_SMALL)[0]
    cats = ["1-URGENT", "2-HIGH", "never seen"]
    names = [f"market_{v}" for v in cats]
    encoded = encode.one_hot(train, "market", cats)
    dense = linear.fit_ridge(encoded, [], [*P2F, *names], "target", 2.0)
    got = linear.fit_ridge_pooled(train, "market", P2F, "target", 2.0, cats)
    assert _table(got) == pytest.approx(_table(dense), rel=1e-8, abs=1e-6)
    want = {r["id"]: r["pred"] for r in linear.score_linear(encoded, dense, [], [*P2F, *names]).collect()}
    mine = {r["id"]: r["pred"] for r in linear.score_pooled(train, got, "market", P2F).collect()}
    assert mine == pytest.approx(want, rel=1e-8)
    # no rows at all: no coefficients
    assert linear.fit_ridge_pooled(train.limit(0), "market", P2F).count() == 0
    # no penalty: slopes of the fit within markets
    pdf = train.dropna(subset=[*P2F, "target"]).toPandas()
    inner = pdf[[*P2F, "target"]] - pdf.groupby("market")[[*P2F, "target"]].transform("mean")
    slopes = np.linalg.lstsq(inner[P2F].to_numpy(), inner["target"].to_numpy(), rcond=None)[0]
    free = _table(linear.fit_ridge_pooled(train, "market", P2F, alpha=0.0))
    assert [free[f] for f in P2F] == pytest.approx(list(slopes), rel=1e-5)


def test_pooled_ridge_many_markets_is_a_table(spark):
    rows = spark.range(60_000).select(F.concat(F.lit("m"), (F.col("id") % 20_000)).alias("market"),
                                      F.rand(1).alias("x"), F.rand(2).alias("z"))
    rows = rows.withColumn("target", 3 * F.col("x") - F.col("z") + F.crc32("market") % 5)
    coefs = linear.fit_ridge_pooled(rows, "market", ["x", "z"], alpha=1e-6)
    assert coefs.count() == 20_003
    got = _table(coefs.where("feature in ('x', 'z')"))
    assert got["x"] == pytest.approx(3, abs=1e-3) and got["z"] == pytest.approx(-1, abs=1e-3)


def test_vif_filter_reads_once_and_equals_rounds_over_the_rows(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(400, 3)) + 1
    X = np.column_stack([base, base[:, 0] + base[:, 1] + 0.01 * rng.normal(size=400), base[:, 2] + 0.02 * rng.normal(size=400)])
    X[rng.random(X.shape) < 0.1] = np.nan
    names = [f"f{i}" for i in range(5)]
    df = spark.createDataFrame([[None if np.isnan(v) else float(v) for v in r] for r in X], ", ".join(f"{c} double" for c in names))

    remaining = list(range(5))
    while len(remaining) > 1:
        part = X[:, remaining][~np.isnan(X[:, remaining]).any(axis=1)]
        vifs = []
        for j in range(len(remaining)):
            rest = np.delete(part, j, 1)
            left = part[:, j] - rest @ np.linalg.lstsq(rest, part[:, j], rcond=None)[0]
            vifs.append(part[:, j] @ part[:, j] / (left @ left))
        if max(vifs) <= 10:
            break
        remaining.pop(int(np.argmax(vifs)))
    assert len(remaining) == 3
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    assert select.vif_filter(df.mapInArrow(counted, df.schema), names) == [names[i] for i in remaining]
    assert read.value == 400
    # a column that is always missing leaves no complete row; an empty table has no Gram
    assert select.vif_filter(df.withColumn("f0", F.lit(None).cast("double")), names) == names
    assert select.vif_filter(df.limit(0), names) == names


def test_checked_reader_names_each_malformed_field(spark, tmp_path):
    spec = fx.P2_SPEC
    header = ",".join(f.name for f in panel_io.panel_schema(spec).fields)
    ok = "1,m,2001-01-01 00:00:00,2001-01-02 00:00:00,1.5,1,2,3,4,5"
    lines = [ok, ok.replace("1.5", "x").replace("1,m", "2,m"), ok.replace("1,m", ",m"), ok.replace("1,m", "4,m") + ",9",
             "5,m,2001-01-01 00:00:00", ok.replace("1,m", "6,m").replace("1.5", "NaN"), ok.replace("1,m", "7,").replace("1.5", ""),
             ok.replace("1,m", "8,m").replace("2001-01-01", "2001-02-30")]
    (tmp_path / "panel.csv").write_text("\n".join([header, *lines]) + "\n")
    checked = panel_io.read_panel_checked(spark, str(tmp_path), spec)
    got = {r["id"]: (r["rejects"], r["target"]) for r in checked.collect()}
    assert got == {1: ([], 1.5), 2: (["target"], None), None: (["id"], 1.5), 4: (["_row"], 1.5), 5: (["_row"], None),
                   6: ([], None), 7: ([], None), 8: (["delivery_start"], 1.5)}
    # asking for one column alone must not change what counts as malformed
    assert checked.select("rejects").where("array_contains(rejects, '_row')").count() == 2
    assert sorted(r["id"] for r in panel_io.accepted_rows(checked).select("id").collect()) == [1, 6, 7]
    report = {r["field"]: (r["n_rows"], r["min_id"], r["max_id"]) for r in panel_io.reject_report(checked).collect()}
    assert report == {"target": (1, 2, 2), "id": (1, None, None), "_row": (2, 4, 5), "delivery_start": (1, 8, 8)}
