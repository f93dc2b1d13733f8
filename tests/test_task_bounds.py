import numpy as np
import pyarrow as pa

from skein.operators import svr, windows
from skein.plans import catalog_flows


def test_pass_over_prepared_rows_uses_few_tasks(spark):
    df = spark.range(500).selectExpr("id", "cast(id % 7 as double) x", "cast(id as double) target")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        prepared, n = svr._prepare(df, ["x"], "target", ["id"])
        assert n == 500 and prepared.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
        assert sorted(r["_pos"] for r in prepared.collect()) == list(range(500))
        prepared.unpersist()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_weighted_gram_of_batches_is_that_of_the_rows():
    rng = np.random.default_rng(2)
    X, y, theta = rng.normal(size=(5000, 3)), rng.normal(size=5000), rng.normal(size=(2, 4))
    batch = pa.RecordBatch.from_arrays([pa.array(X.tolist()), pa.array(y), pa.array(np.arange(5000))], ["_x", "_y", "_pos"])
    cuts = [(0, 3000), (1000, 5000)]
    run = svr._kernel(3, theta, [(0.1, 0.2)] * 2, cuts, 1e-9)
    cells = np.array(next(run(iter([batch]))).column(0).to_pylist()[0])
    for m, (lo, hi) in enumerate(cuts):
        X1 = np.hstack([np.ones((hi - lo, 1)), X[lo:hi]])
        r = np.abs(y[lo:hi] - X1 @ theta[m])
        u = np.where(r > 0.2, 1 / np.maximum(r - 0.2, 1e-9), 0.5 / np.maximum(0.2 - r, 1e-9))
        assert np.allclose(cells[m * 16:(m + 1) * 16].reshape(4, 4), (X1 * u[:, None]).T @ X1)


def test_a_large_market_is_split_by_default():
    assert windows.DEFAULT_BUCKET_ROWS <= 500_000


def test_flow_panels_are_read_from_files(spark):
    assert all(df.inputFiles() and "gram-" in df.inputFiles()[0]
               for df in catalog_flows._panels(spark, "/root/testdata/sf0.001"))
