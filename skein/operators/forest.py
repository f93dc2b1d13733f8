"""Random-forest impurity importances level by level, parallel over row groups and trees.

The forest is that of MLlib's regressor: at most ``MAX_BINS`` bins a feature, a Poisson(1) bootstrap a tree, every feature
weighed at each split, the split of largest variance reduction, nodes of the last depth are leaves. The rows are binned
once and kept as compact blocks (one byte a feature). A level is one job: a task holds one row group (``GROUP_BYTES``) and
some of the trees, follows its rows to their nodes and sums weight and target by node, feature and bin. With several row
groups these sums are shuffled by (tree, nodes) and added; the driver gets one split a node. Work is spread over trees
where the rows are few and over rows where they are many, and no task's memory grows with the input.

With several row groups the sums that are sent soon outweigh the rows. Up to ``WHOLE_BYTES`` of packed rows a task holds all
of them instead and grows some of the trees from root to leaves (``_grown``), without sums sent or a job a level. Features
with few bins share a byte (``packed_features``), so that one pass sums several of them, and of two sibling nodes only the
lighter one's rows are summed, the other's sums being the parent's less these. The target is rounded to a grid on which all
sums are exact (``target_grid``), so neither changes the splits, and features that split alike stay tied: the first wins.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.operators.gram import written

MAX_BINS = 32
#: Bytes of binned rows that a task holds, and of sums of nodes that are sent as one record.
GROUP_BYTES = 64 << 20
CHUNK_BYTES = 4 << 20
#: Groups of (rows, trees) for each core.
TASKS_PER_CORE = 4
#: Bytes of packed rows that a task may hold to grow whole trees over them, and tasks for each core that do.
WHOLE_BYTES = 256 << 20
GROWERS_PER_CORE = 2
#: Codes of the features that share a byte, rows that are summed at once and nodes that are split at once.
CODES = 256
STEP_ROWS = 1 << 17
STEP_NODES = 64

_SPLITS = "t int, c int, feat binary, cut binary, gain binary, left binary, right binary"


def bin_cuts(rows: DataFrame, cols, max_bins: int = MAX_BINS) -> list[np.ndarray]:
    """Upper bounds of all bins but the last: every value but the largest of a column with at most ``max_bins`` values,
    else its quantiles."""
    shares = [i / max_bins for i in range(1, max_bins)]
    stats = rows.agg(*[F.percentile_approx(c, shares, 10_000).alias(f"q_{c}") for c in cols],
                     *[F.max(c).alias(f"max_{c}") for c in cols],
                     *[F.approx_count_distinct(c).alias(f"n_{c}") for c in cols]).first()
    few = [c for c in cols if stats[f"n_{c}"] <= 2 * max_bins]
    values = {c: set() for c in few}
    if few:
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in few]))
        for r in rows.select(pairs.alias("p")).select("p.*").distinct().collect():  # a few dozen values a column
            values[r["c"]].add(r["v"])
    out = []
    for c in cols:
        at = sorted(values[c]) if c in values and len(values[c]) <= max_bins else sorted(set(stats[f"q_{c}"]))
        out.append(np.array([v for v in at if v < stats[f"max_{c}"]], float))
    return out


def _binned(cols, cuts, centre: float):
    """Blocks of rows: ``bins`` (feature by feature, one byte each) and ``y`` about ``centre``."""
    def run(it):
        for pdf in it:
            if len(pdf):
                bins = [np.searchsorted(cut, pdf[c].to_numpy(dtype=np.float64), side="left") for c, cut in zip(cols, cuts)]
                yield pd.DataFrame({"n": [len(pdf)], "bins": [np.array(bins, np.uint8).tobytes()],
                                    "y": [(pdf["_y"].to_numpy(dtype=np.float64) - centre).tobytes()]})

    return run


def _poisson_table() -> np.ndarray:
    """Poisson(1) draws by 16 random bits."""
    p = np.cumsum([np.exp(-1.0) / f for f in np.cumprod([1.0, *range(1, 9)])])
    return np.searchsorted(p, (np.arange(65536) + 0.5) / 65536).astype(np.uint8)


def best_splits(H: np.ndarray) -> dict:
    """``H``: nodes x features x bins x (weight, target sum). Of each node the split of largest variance reduction (times
    its weight; 0: none), with the weights of both sides. Ties keep the first feature and bin."""
    left = np.cumsum(H, axis=2)
    total = left[:, :, -1:, :]
    right = total - left
    with np.errstate(invalid="ignore", divide="ignore"):
        parts = left[..., 1] ** 2 / left[..., 0] + right[..., 1] ** 2 / right[..., 0]
        gain = parts - total[..., 1] ** 2 / total[..., 0]
    gain = np.where((left[..., 0] > 0) & (right[..., 0] > 0) & (gain > 1e-12 * parts), gain, 0.0).reshape(len(H), -1)
    at = gain.argmax(axis=1)
    feat, cut = np.divmod(at, H.shape[2])
    i = np.arange(len(H))
    return {"feat": feat.astype(np.int16), "cut": cut.astype(np.uint8), "gain": gain[i, at],
            "left": left[i, feat, cut, 0], "right": right[i, feat, cut, 0]}


def _followed(flat, k, rows, feat, cut, level, step=1 << 15):
    """The nodes of ``rows`` after ``level`` splits. What comes to a leaf goes on to the left, to nodes that are not open."""
    feat, out = np.maximum(feat, 0), np.empty(len(rows), np.int64)
    for lo in range(0, len(rows), step):
        at = rows[lo:lo + step] * k
        node = np.ones(len(at), np.int64)
        for _ in range(level):
            right = flat.take(at + feat.take(node)) > cut.take(node)
            node <<= 1
            node += right
        out[lo:lo + step] = node
    return out


def _level(k, level, trees, open_nodes, feat, cut, seed, n_groups, whole):
    """Of a task's rows: the sums of the open nodes of its trees; their best splits where the rows are ``whole``."""
    draws = _poisson_table()
    per_chunk = max(1, CHUNK_BYTES // (k * MAX_BINS * 16))

    def run(key, pdf):
        pdf = pdf.sort_values("b")
        bins = np.concatenate([np.frombuffer(b, np.uint8).reshape(k, -1) for b in pdf["bins"]], axis=1)
        flat = np.ascontiguousarray(bins.T).ravel()
        y = np.concatenate([np.frombuffer(v) for v in pdf["y"]])
        out = []
        for t in range(int(key[1]), trees, n_groups):
            nodes = open_nodes[t]
            if not len(nodes):
                continue
            w = np.concatenate([draws[np.random.default_rng([seed, t, int(b)]).integers(0, 65536, n, dtype=np.uint16)]
                                for b, n in zip(pdf["b"], pdf["n"])])
            rows = np.flatnonzero(w)
            node = _followed(flat, k, rows, feat[t].astype(np.int64), cut[t], level)
            place = np.full(1 << (level + 1), -1, np.int64)
            place[nodes] = np.arange(len(nodes))
            slot = place[node]
            rows, slot = rows[slot >= 0], slot[slot >= 0] * MAX_BINS
            weight = w[rows].astype(np.float64)
            wy = weight * y[rows]
            H = np.empty((len(nodes), k, MAX_BINS, 2))
            size = len(nodes) * MAX_BINS
            for i in range(k):
                at = slot + bins[i][rows]
                H[:, i, :, 0] = np.bincount(at, weight, size).reshape(-1, MAX_BINS)
                H[:, i, :, 1] = np.bincount(at, wy, size).reshape(-1, MAX_BINS)
            for c in range(0, len(nodes), per_chunk):
                part = H[c:c + per_chunk]
                out.append([t, c, *(v.tobytes() for v in best_splits(part).values())] if whole else [t, c, part.tobytes()])
        return pd.DataFrame(out, columns=["t", "c", *(("feat", "cut", "gain", "left", "right") if whole else ("sums",))])

    return run


def _added(k):
    def run(key, pdf):
        H = sum(np.frombuffer(v).reshape(-1, k, MAX_BINS, 2) for v in pdf["sums"])
        return pd.DataFrame([[*key, *(v.tobytes() for v in best_splits(H).values())]],
                            columns=["t", "c", "feat", "cut", "gain", "left", "right"])

    return run


def packed_features(cuts) -> list[list[tuple[int, int, int]]]:
    """Features that share a byte: lists of (feature, stride, bins), largest first; features of one bin are in none."""
    out, size = [], []
    for bins, i in sorted(((len(cut) + 1, i) for i, cut in enumerate(cuts)), key=lambda x: (-x[0], x[1])):
        if bins < 2:
            continue
        at = next((j for j, n in enumerate(size) if n * bins <= CODES), len(size))
        if at == len(size):
            out.append([])
            size.append(1)
        out[at].append((i, size[at], bins))
        size[at] *= bins
    return out


def target_grid(low: float, high: float, rows: int) -> float:
    """A power of two: targets within [low, high] times it, rounded, add up exactly over twice the rows."""
    reach = max(abs(low), abs(high)) * (2 * rows + 100)
    return 2.0 ** np.floor(np.log2(2.0 ** 52 / reach)) if reach > 0 else 1.0


def _packed(cols, cuts, packs, centre: float, grid: float):
    """Blocks of rows: ``codes`` (pack by pack, one byte each) and ``y`` about ``centre`` in steps of ``1 / grid``."""
    def run(it):
        for pdf in it:
            if len(pdf):
                bins = [np.searchsorted(cut, pdf[c].to_numpy(dtype=np.float64), side="left") for c, cut in zip(cols, cuts)]
                codes = [sum(bins[i] * stride for i, stride, _ in pack).astype(np.uint8) for pack in packs]
                y = np.rint((pdf["_y"].to_numpy(dtype=np.float64) - centre) * grid)
                yield pd.DataFrame({"n": [len(pdf)], "codes": [np.array(codes, np.uint8).tobytes()], "y": [y.tobytes()]})

    return run


def _add_rows(codes, sizes, place, w, y, n):
    """Of ``n`` places the sums by pack and code, each (weights, targets) x places x codes: rows ``place`` >= 0 count."""
    H = [np.zeros((2, n * size)) for size in sizes]
    step = max(STEP_ROWS, 2 * n * CODES)  # adding up the cells costs less than the rows
    for lo in range(0, len(place), step):
        at = np.flatnonzero(place[lo:lo + step] >= 0) + lo
        if not len(at):
            continue
        to, weight = place.take(at).astype(np.int64), w.take(at).astype(np.float64)
        wy = weight * y.take(at)
        for h, code, size in zip(H, codes, sizes):
            cell = to * size + code.take(at)
            h[0] += np.bincount(cell, weight, n * size)
            h[1] += np.bincount(cell, wy, n * size)
    return [h.reshape(2, n, size) for h, size in zip(H, sizes)]


def _packed_splits(H, packs, k):
    """``best_splits`` of all nodes from their sums by pack."""
    parts = []
    for lo in range(0, H[0].shape[1], STEP_NODES):
        n = min(STEP_NODES, H[0].shape[1] - lo)
        cells = np.zeros((n, k, MAX_BINS, 2))
        for h, pack in zip(H, packs):
            for i, stride, bins in pack:
                by = h[:, lo:lo + n].reshape(2, n, -1, bins, stride).sum(axis=(2, 4))
                cells[:, i, :bins] = by.transpose(1, 2, 0)
        parts.append(best_splits(cells))
    return {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}


def grown_tree(codes, y, w, packs, k, depth) -> np.ndarray:
    """Variance reductions by feature of the splits of one tree. ``codes``: packs x rows; ``w``: the rows' bootstrap weights."""
    shares = np.zeros(k)
    rows = np.flatnonzero(w)
    if not len(rows):
        return shares
    codes, y, w = codes.take(rows, axis=1), y.take(rows), w.take(rows)
    sizes = [pack[-1][1] * pack[-1][2] for pack in packs]
    where = {i: (j, stride, bins) for j, pack in enumerate(packs) for i, stride, bins in pack}
    node, n = np.zeros(len(rows), np.int32), 1  # rows of closed nodes are at n
    H = _add_rows(codes, sizes, node, w, y, 1)
    for level in range(depth):
        best = _packed_splits(H, packs, k)
        inner = best["gain"] > 0
        np.add.at(shares, best["feat"][inner], best["gain"][inner])
        heavy = np.stack([best["left"], best["right"]], 1)
        opens = inner[:, None] & (heavy > 1)
        if level == depth - 1 or not opens.any():
            break
        # to which side a node's codes go; rows of closed nodes stay
        right, pack_of = np.zeros((n + 1, CODES), bool), np.zeros(n + 1, np.int64)
        for i in np.unique(best["feat"][inner]):
            at = np.flatnonzero(inner & (best["feat"] == i))
            j, stride, bins = where[int(i)]
            pack_of[at] = j
            right[at] = np.arange(CODES) // stride % bins > best["cut"][at, None]
        following = np.full((n + 1, 2), -1, np.int64)
        following[:n][opens] = np.arange(opens.sum())
        light = np.argmin(heavy, 1)  # of every parent of open nodes the side whose rows are summed
        parents = np.flatnonzero(opens.any(1))
        summed = np.full((n + 1, 2), -1, np.int32)
        summed[parents, light[parents]] = np.arange(len(parents))
        count = int(opens.sum())
        following[following < 0] = count
        go = following.astype(np.int32).ravel()
        summed, place, right = summed.ravel(), np.empty(len(node), np.int32), right.ravel()
        for lo in range(0, len(node), STEP_ROWS):
            own = node[lo:lo + STEP_ROWS].astype(np.int64)
            code = codes.ravel().take(pack_of.take(own) * len(node) + np.arange(lo, lo + len(own)))
            side = 2 * own + right.take(own * CODES + code)
            place[lo:lo + STEP_ROWS], node[lo:lo + STEP_ROWS] = summed.take(side), go.take(side)
        lights = _add_rows(codes, sizes, place, w, y, len(parents))
        which, side = np.nonzero(opens)
        pair = np.searchsorted(parents, which)
        is_light = (side == light[which])[None, :, None]
        H = [np.where(is_light, part[:, pair], h[:, which] - part[:, pair]) for h, part in zip(H, lights)]
        n = count
        live = node < n
        if live.mean() < 0.8:
            at = np.flatnonzero(live)
            codes, y, w, node = codes.take(at, axis=1), y.take(at), w.take(at), node.take(at)
    return shares


def _grown(packs, k, trees, groups, depth, seed):
    """Of a task's rows, which are all, the variance reductions by feature of every tree of its group."""
    draws = _poisson_table()

    def run(batches):
        group, blocks = None, []
        for batch in batches:
            for g, b, n, codes, y in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist()
                                           for c in ("g", "b", "n", "codes", "y"))):
                group = g
                blocks.append((b, n, np.frombuffer(codes, np.uint8).reshape(len(packs), n), np.frombuffer(y)))
        if group is None:
            return
        codes = np.concatenate([x[2] for x in blocks], axis=1)
        y, blocks = np.concatenate([x[3] for x in blocks]), [x[:2] for x in blocks]
        for t in range(group, trees, groups):
            w = np.concatenate([draws[np.random.default_rng([seed, t, b]).integers(0, 65536, n, dtype=np.uint16)]
                                for b, n in blocks])
            shares = grown_tree(codes, y, w, packs, k, depth)
            yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([shares.tolist()])], names=["t", "shares"])

    return run


def _whole_shares(rows, cols, cuts, packs, head, trees, depth, seed) -> np.ndarray:
    """Variance reductions by tree and feature: every task holds all rows and grows some of the trees."""
    spark, k = rows.sparkSession, len(cols)
    grid = target_grid(head["low"] - head["y"], head["high"] - head["y"], head["n"])
    blocks = written(rows.mapInPandas(_packed(cols, cuts, packs, head["y"], grid), "n long, codes binary, y binary")
                     .withColumn("b", F.monotonically_increasing_id()))
    groups = min(trees, GROWERS_PER_CORE * spark.sparkContext.defaultParallelism)
    dealt = blocks.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).repartitionById(groups, F.col("g"))
    shares = np.zeros((trees, k))
    for r in dealt.mapInArrow(_grown(packs, k, trees, groups, depth, seed), "t int, shares array<double>").collect():
        shares[r["t"]] = r["shares"]  # k numbers a tree
    return shares


def _averaged(shares: np.ndarray) -> np.ndarray:
    total = shares.sum(axis=1, keepdims=True)
    mean = np.divide(shares, total, out=np.zeros_like(shares), where=total > 0).sum(axis=0)
    return mean / mean.sum() if mean.sum() > 0 else mean


def forest_importance(df: DataFrame, features, target: str, n_estimators: int, max_depth: int, seed: int) -> np.ndarray:
    """Importance of each feature: the variance reductions of its splits times their weights, as shares by tree, averaged.
    Rows with missing values are left out."""
    spark, k = df.sparkSession, len(features)
    cols = [f"_f{i}" for i in range(k)]
    rows = written(df.select(*[F.col(c).cast("double").alias(n) for c, n in zip(features, cols)],
                             F.col(target).cast("double").alias("_y")).dropna())
    head = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("_y").alias("y"), F.min("_y").alias("low"),
                    F.max("_y").alias("high")).first()
    if not head["n"]:
        raise ValueError("no rows without missing values")
    cuts = bin_cuts(rows, cols)
    packs = packed_features(cuts)
    parts = -(-head["n"] * (k + 8) // GROUP_BYTES)
    if parts > 1 and packs and head["n"] * (len(packs) + 8) <= WHOLE_BYTES:
        return _averaged(_whole_shares(rows, cols, cuts, packs, head, n_estimators, max_depth, seed))
    blocks = written(rows.mapInPandas(_binned(cols, cuts, head["y"]), "n long, bins binary, y binary")
                     .withColumn("b", F.monotonically_increasing_id()))
    groups = min(n_estimators, max(1, -(-TASKS_PER_CORE * spark.sparkContext.defaultParallelism // parts)))
    dealt = blocks.withColumn("p", F.pmod(F.xxhash64("b"), F.lit(parts))).withColumn(
        "g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).repartition(parts * groups, "p", "g")
    dealt = dealt.persist(StorageLevel.DISK_ONLY)
    feat, cut = np.full((n_estimators, 1 << max_depth), -1, np.int16), np.zeros((n_estimators, 1 << max_depth), np.uint8)
    shares = np.zeros((n_estimators, k))
    open_nodes = [np.array([1])] * n_estimators
    try:
        for level in range(max_depth):
            if not any(len(x) for x in open_nodes):
                break
            run = _level(k, level, n_estimators, open_nodes, feat, cut, seed, groups, parts == 1)
            sums = dealt.groupBy("p", "g").applyInPandas(run, _SPLITS if parts == 1 else "t int, c int, sums binary")
            splits = sums if parts == 1 else sums.groupBy("t", "c").applyInPandas(_added(k), _SPLITS)
            following = [[] for _ in range(n_estimators)]
            for r in splits.collect():  # one split a node
                t, gain, f = r["t"], np.frombuffer(r["gain"]), np.frombuffer(r["feat"], np.int16)
                nodes, inner = open_nodes[t][r["c"]:r["c"] + len(gain)], gain > 0
                feat[t, nodes[inner]], cut[t, nodes[inner]] = f[inner], np.frombuffer(r["cut"], np.uint8)[inner]
                np.add.at(shares[t], f[inner], gain[inner])
                for side, name in enumerate(("left", "right")):
                    following[t].append(2 * nodes[inner & (np.frombuffer(r[name]) > 1)] + side)
            open_nodes = [np.sort(np.concatenate(x)) if x else np.zeros(0, int) for x in following]
    finally:
        dealt.unpersist()
    return _averaged(shares)
