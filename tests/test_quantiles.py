import numpy as np
import pytest

from skein.operators import quantiles as q


def check(spark, rows, probs, groups=("g",), cols=("x",)):
    schema = "g string, " + ", ".join(f"{c} double" for c in cols)
    df = spark.createDataFrame(rows, schema).repartition(3)
    got = {(r["g"] if groups else None, r.column_name, r.prob): r.value
           for r in q.exact_quantiles(df, list(groups), list(cols), probs).collect()}
    want = {}
    for g in {r[0] for r in rows} if groups else {None}:
        for i, c in enumerate(cols):
            x = [r[1 + i] for r in rows if (not groups or r[0] == g) and r[1 + i] is not None]
            for p in probs if x else ():
                want[g, c, p] = float(np.quantile(np.array(x), p))
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == pytest.approx(v, rel=1e-13, abs=1e-300), k


@pytest.fixture(params=[3, 4096])
def gather(request, monkeypatch):
    """Few rows in the last pass, so that linear passes are needed, or many."""
    monkeypatch.setattr(q, "GATHER", request.param)
    monkeypatch.setattr(q, "CELLS", 16 if request.param == 3 else 4096)
    return request.param


def test_groups_nulls_and_probabilities(spark, gather):
    rng = np.random.default_rng(1)
    rows = [(str(g) if g else None, float(rng.normal(0, 10.0 ** rng.integers(-5, 6))), None if i % 3 else float(i))
            for g in range(3) for i in range(150)]
    check(spark, rows + [("lonely", 4.5, None), ("pair", -1.0, 0.0), ("pair", 1.0, -0.5)], [0.0, 0.25, 0.5, 0.75, 1.0],
          cols=("x", "y"))
    check(spark, rows, [0.1, 0.5], groups=(), cols=("x", "y"))


def test_ninety_nine_percent_equal_values(spark, gather):
    rng = np.random.default_rng(2)
    rows = [("hot", 7.25)] * 1980 + [("hot", float(v)) for v in rng.normal(7, 3, 20)]
    check(spark, rows, [0.001, 0.25, 0.5, 0.75, 0.999])


def test_extreme_magnitudes(spark, gather):
    rows = [("a", v) for v in (0.0, -0.0, 5e-324, -5e-324, 1e-300, 1e300, -1e300, 1.7e308, -1.7e308, 1.0, 1.0 + 2**-52, 2.0)]
    check(spark, rows * 3, [0.0, 0.3, 0.6, 0.8])
    check(spark, [("a", 1.0 + i * 2**-52) for i in range(60)], [0.2, 0.5, 0.9])


def test_no_rows_are_sorted_or_shuffled(spark):
    df = spark.range(20_000).selectExpr("cast(id % 7 as string) g", "cast(id * 37 % 20011 as double) x")
    out = q.exact_quantiles(df, ["g"], ["x"], [0.5])
    assert out.count() == 7
    empty = q.exact_quantiles(df.where("id < 0"), ["g"], ["x"], [0.5])
    assert empty.count() == 0
