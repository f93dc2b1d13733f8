import numpy as np
from pyspark.sql import functions as F

from skein.operators import forest


def _rows(spark, n):
    return spark.range(n, numPartitions=1).select(
        (F.col("id") % 4).cast("double").alias("strong"), F.rand(3).alias("weak"), F.rand(4).alias("noise")).withColumn(
        "target", 10 * F.col("strong") + 3 * F.col("weak") + F.rand(5))


def test_rows_of_one_partition_are_shared_out_and_row_groups_change_nothing(spark, monkeypatch):
    df = _rows(spark, 30_000)
    args = (df, ["strong", "weak", "noise"], "target", 6, 5, 7)
    whole = forest.forest_importance(*args)
    monkeypatch.setattr(forest, "GROUP_BYTES", 100_000)  # four groups of rows, sums in several records
    monkeypatch.setattr(forest, "CHUNK_BYTES", 5_000)
    assert np.allclose(whole, forest.forest_importance(*args), atol=1e-9)
    assert whole[0] > whole[1] > whole[2] >= 0 and abs(whole.sum() - 1) < 1e-12


def test_best_split_is_that_of_all_cuts():
    rng = np.random.default_rng(1)
    n = 300
    bins, y, w = rng.integers(0, forest.MAX_BINS, (2, n)), rng.normal(size=n), rng.poisson(1.0, n).astype(float)
    H = np.zeros((1, 2, forest.MAX_BINS, 2))
    for f in range(2):
        H[0, f, :, 0], H[0, f, :, 1] = np.bincount(bins[f], w, forest.MAX_BINS), np.bincount(bins[f], w * y, forest.MAX_BINS)

    def spread(m):
        return 0.0 if not w[m].sum() else (w[m] * (y[m] - np.average(y[m], weights=w[m])) ** 2).sum()

    every = np.ones(n, bool)
    gains = {(f, c): spread(every) - spread(bins[f] <= c) - spread(bins[f] > c)
             for f in range(2) for c in range(forest.MAX_BINS - 1)}
    best = max(gains, key=gains.get)
    got = forest.best_splits(H)
    assert (got["feat"][0], got["cut"][0]) == best and abs(got["gain"][0] - gains[best]) < 1e-9


def test_splits_of_an_exact_tree_and_rows_with_gaps(spark):
    df = spark.createDataFrame([(0.0, 1.0, 5.0), (1.0, 1.0, 9.0), (None, 1.0, 7.0), (1.0, 1.0, None)] * 50,
                               "a double, b double, target double")
    assert forest.forest_importance(df, ["a", "b"], "target", 4, 3, 1).tolist() == [1.0, 0.0]
    assert forest.forest_importance(df, ["b"], "target", 4, 3, 1).tolist() == [0.0]
    assert [c.tolist() for c in forest.bin_cuts(df.dropna(), ["a", "b"])] == [[0.0], []]


def test_best_split_of_an_empty_side_is_none():
    H = np.zeros((1, 1, forest.MAX_BINS, 2))
    H[0, 0, 3] = 2.0, 4.0
    assert forest.best_splits(H)["gain"].tolist() == [0.0]


def test_features_of_few_bins_share_a_byte_and_all_but_constant_ones_are_in_one():
    cuts = [np.arange(b - 1.0) for b in (32, 7, 1, 7, 12, 2, 2, 32)]
    packs = forest.packed_features(cuts)
    assert sorted(i for pack in packs for i, *_ in pack) == [0, 1, 3, 4, 5, 6, 7] and len(packs) < 7
    for pack in packs:
        assert np.prod([bins for *_, bins in pack]) <= forest.CODES
        assert [stride for _, stride, _ in pack] == np.cumprod([1, *[bins for *_, bins in pack]])[:-1].tolist()


def test_grown_tree_is_that_of_plain_sums():
    """Against sums of every node's rows by feature: no shared bytes, no sums from siblings."""
    rng, n, depth = np.random.default_rng(3), 4000, 7
    bins = np.array([rng.integers(0, 32, n), rng.integers(0, 7, n), rng.integers(0, 2, n), rng.integers(0, 12, n)])
    bins = np.vstack([bins, bins[1]])  # a feature that splits as another does: the first wins
    y, w = np.rint(40 * (bins[0] % 5 + bins[1] * bins[2]) + 100 * rng.normal(size=n)), rng.poisson(1.0, n).astype(np.uint8)
    packs = forest.packed_features([np.arange(b - 1.0) for b in (32, 7, 2, 12, 7)])
    codes = np.array([sum(bins[i] * stride for i, stride, _ in pack) for pack in packs], np.uint8)
    want, open_nodes = np.zeros(5), [np.flatnonzero(w)]
    for _ in range(depth):
        following = []
        for rows in open_nodes:
            H = np.zeros((1, 5, forest.MAX_BINS, 2))
            for f in range(5):
                np.add.at(H[0, f, :, 0], bins[f, rows], w[rows])
                np.add.at(H[0, f, :, 1], bins[f, rows], w[rows] * y[rows])
            best = forest.best_splits(H)
            if best["gain"][0] > 0:
                want[best["feat"][0]] += best["gain"][0]
                right = bins[best["feat"][0], rows] > best["cut"][0]
                following += [x for x in (rows[~right], rows[right]) if w[x].sum() > 1]
        open_nodes = following
    got = forest.grown_tree(codes, y, w, packs, 5, depth)
    assert np.allclose(got, want, rtol=1e-9) and want[:4].all() and got[4] == 0


def test_rows_of_several_groups_grow_whole_trees_without_sums_sent(spark, monkeypatch):
    df = _rows(spark, 20_000)
    args = (df, ["strong", "weak", "noise"], "target", 5, 4, 7)
    whole = forest.forest_importance(*args)
    monkeypatch.setattr(forest, "GROUP_BYTES", 50_000)
    level = forest._level
    monkeypatch.setattr(forest, "_level", lambda *a: 1 / 0)  # was a job a level, with sums shuffled by node
    assert np.allclose(whole, forest.forest_importance(*args), atol=1e-9)
    monkeypatch.setattr(forest, "_level", level)
    monkeypatch.setattr(forest, "WHOLE_BYTES", 0)  # more rows than a task may hold
    assert np.allclose(whole, forest.forest_importance(*args), atol=1e-9)
