"""Linear ε-insensitive SVR, grid search over time-series folds, RBF via random features.

Objective (per model): J(w, b) = mean max(0, |y - x·w - b| - ε) + α/2 ||w||².

Re-aimed solver: majorize-minimize. At the current residuals r⁰ every loss term is
bounded by a quadratic that touches it at r⁰ (outside the tube:
(r - ε·sign r⁰)² / (2(|r⁰| - ε)) + const; inside: (r - r⁰)² / (4(ε - |r⁰|))), so each
iteration is a weighted ridge solve whose sufficient statistics (a weighted Gram)
come from ONE distributed pass, and J never increases. All candidates of a grid and
all time-series folds are fitted in the same passes: each row carries a fold mask and
every (candidate, fold) model gets its own weighted Gram.

RBF kernel: random Fourier features (Rahimi & Recht, 2007), applied inside the tasks to each
Arrow batch as one matrix product, followed by the same linear solver (α = 1 / (C · n)).
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from skein.operators.evaluate import metric_exprs, null_inputs
from skein.operators.positions import with_positions
from skein.spec import KERNEL_GRID, SGD_GRID

CONST = "const"


#: Rows that a task weighs at once, so that they stay in the processor's cache.
STEP_ROWS = 2048
#: Rows of a task of a pass, where that gives more tasks than twice the cores.
TASK_ROWS = 200_000


def _arrays(batch):
    """Features, target and positions of an Arrow batch of prepared rows, a few at a time."""
    x, y, pos = (batch.column(batch.schema.get_field_index(c)) for c in ("_x", "_y", "_pos"))
    y, pos = y.to_numpy(zero_copy_only=False), pos.to_numpy(zero_copy_only=False)
    X = x.flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1) if len(y) else np.zeros((0, 0))
    for lo in range(0, len(y), STEP_ROWS):
        yield X[lo:lo + STEP_ROWS], y[lo:lo + STEP_ROWS], pos[lo:lo + STEP_ROWS]


def _cells(values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([values], pa.list_(pa.float64()))], ["_v"])


def _kernel(k: int, thetas: np.ndarray, alphas_eps, cuts, delta: float, init: bool = False, featurize=None):
    """Per-partition weighted Gram of every model. ``cuts[m]`` = (lo, hi) row-position range
    of model m's training rows."""
    M = thetas.shape[0]
    k1 = k + 1
    eps = np.array([e for _, e in alphas_eps], dtype=float)
    ranges = {}
    for m, cut in enumerate(cuts):
        ranges.setdefault(tuple(cut), []).append(m)

    def run(it):
        A = np.zeros((M, k1, k1)); B = np.zeros((M, k1)); loss = np.zeros(M); cnt = np.zeros(M)
        for X, y, pos in (part for batch in it for part in _arrays(batch)):
            if featurize is not None:
                X = featurize(X)
            X1 = np.hstack([np.ones((X.shape[0], 1)), X])
            for (lo, hi), models in ranges.items():
                mask = (pos >= lo) & (pos < hi)
                if not mask.any():
                    continue
                Xm, ym = (X1, y) if mask.all() else (X1[mask], y[mask])
                e = eps[models]
                R = ym[:, None] - Xm @ thetas[models].T
                absr = np.abs(R)
                out = absr > e
                if init:  # plain least squares start
                    u, c = np.ones_like(R), np.zeros_like(R)
                else:
                    u = np.where(out, 1.0 / np.maximum(absr - e, delta), 0.5 / np.maximum(e - absr, delta))
                    c = np.where(out, e * np.sign(R), R)
                root = np.sqrt(u)
                for i, m in enumerate(models):
                    S = Xm * root[:, i, None]
                    A[m] += S.T @ S  # one array times itself: half the products
                B[models] += (u * (ym[:, None] - c)).T @ Xm
                loss[models] += np.maximum(absr - e, 0.0).sum(axis=0)
                cnt[models] += len(ym)
        yield _cells(np.concatenate([A.ravel(), B.ravel(), loss, cnt]))

    return run


# Partial-sum rows (one per task) up to this many cells in total are added on the driver;
# beyond it Spark sums them cell by cell.
MAX_DRIVER_CELLS = 5_000_000


def _sum_partials(parts: DataFrame, n_parts: int, size: int) -> np.ndarray:
    cells = np.zeros(size)
    if n_parts * size <= MAX_DRIVER_CELLS:
        for r in parts.collect():
            cells += np.asarray(r["_v"], dtype=np.float64)
        return cells
    summed = parts.select(F.posexplode("_v").alias("_i", "_x")).groupBy("_i").agg(F.sum("_x").alias("_x"))
    for r in summed.collect():
        cells[r["_i"]] = r["_x"]
    return cells


def _solve_batch(prepared: DataFrame, k: int, alphas_eps, cuts, max_iter: int = 60, tol: float = 1e-7,
                 delta: float = 1e-9, featurize=None):
    """Fit every model (alpha, eps, row range) together. A model whose objective has settled leaves the later passes.

    Returns thetas (M x (k+1)), objectives and whether each model settled within ``max_iter`` passes."""
    M, k1 = len(alphas_eps), k + 1
    thetas, obj = np.zeros((M, k1)), np.full(M, np.inf)
    settled = np.zeros(M, bool)
    alphas = np.array([a for a, _ in alphas_eps], dtype=float)
    D0 = np.eye(k1)
    D0[0, 0] = 0.0
    n_parts = prepared.rdd.getNumPartitions()
    for step in range(max_iter):
        live = np.flatnonzero(~settled)
        m = len(live)
        run = _kernel(k, thetas[live], [alphas_eps[i] for i in live], [cuts[i] for i in live], delta, init=step == 0,
                      featurize=featurize)
        cells = _sum_partials(prepared.mapInArrow(run, "_v array<double>"), n_parts, m * k1 * k1 + m * k1 + 2 * m)
        A, B, loss, cnt = np.split(cells, np.cumsum([m * k1 * k1, m * k1, m]))
        A, B, cnt = A.reshape(m, k1, k1), B.reshape(m, k1), np.maximum(cnt, 1.0)
        going = np.ones(m, bool)
        if step:
            now = loss / cnt + 0.5 * alphas[live] * np.sum(thetas[live, 1:] ** 2, axis=1)
            going = np.abs(obj[live] - now) > tol * np.maximum(np.abs(now), 1e-12)
            obj[live] = now
            settled[live[~going]] = True
            if not going.any():
                break
        for j in np.flatnonzero(going):
            lhs = A[j] / cnt[j] + alphas[live[j]] * D0
            thetas[live[j]] = np.linalg.lstsq(lhs, B[j] / cnt[j], rcond=None)[0]
    return thetas, obj, settled


def _prepare(df: DataFrame, features, target: str, order_cols):
    rows = df.select(*dict.fromkeys([*order_cols, *features, target])).dropna(subset=[*features, target])
    ranked = with_positions(rows, [], order_cols, pos_col="_pos", count_col="_n")
    prepared = ranked.select(F.array(*[F.col(c).cast("double") for c in features]).alias("_x"),
                             F.col(target).cast("double").alias("_y"), "_pos", "_n")
    first = prepared.select("_n").first()
    n = int(first[0]) if first else 0
    # Many passes read few numbers a row: no more tasks than keep the cores busy and a task's rows few.
    tasks = max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-n // TASK_ROWS))
    if tasks < prepared.rdd.getNumPartitions():
        prepared = prepared.coalesce(tasks)
    return prepared.persist(StorageLevel.MEMORY_AND_DISK), n


def _coef_table(spark, features, theta):
    rows = [(CONST, float(theta[0]))] + [(f, float(v)) for f, v in zip(features, theta[1:])]
    return spark.createDataFrame(rows, "feature string, coef double")


def train_linear_svr(df: DataFrame, features, target: str = "target", alpha: float = 1e-4,
                     epsilon: float = 0.1, order_cols=None, max_iter: int = 60) -> DataFrame:
    """Linear ε-insensitive SVR on all rows -> coefficient table (feature, coef)."""
    features = list(features)
    prepared, n = _prepare(df, features, target, list(order_cols or [*features, target]))
    try:
        thetas, _, _ = _solve_batch(prepared, len(features), [(alpha, epsilon)], [(0, n)], max_iter)
    finally:
        prepared.unpersist()
    return _coef_table(df.sparkSession, features, thetas[0])


def time_series_folds(n: int, n_splits: int = 3):
    """TimeSeriesSplit: fold i trains on [0, n - (k - i)·s) and tests on the next s rows."""
    s = n // (n_splits + 1)
    out = []
    for i in range(n_splits):
        start = n - (n_splits - i) * s
        out.append(((0, start), (start, start + s)))
    return out


def _known_keys(grid: dict, known) -> None:
    unknown = sorted(set(grid) - set(known))
    if unknown:
        raise ValueError(f"Unknown grid keys: {unknown}; known are {list(known)}")


def grid_search(df: DataFrame, features, target: str = "target", param_grid: dict | None = None,
                n_splits: int = 3, order_cols=None, max_iter: int = 60):
    """Grid × TimeSeriesSplit(n_splits), scored by MAE, best refit on all rows.

    Candidates that share (alpha, epsilon) define the same objective, so they are fitted
    once (the optimiser-path parameters ``learning_rate``/``eta0`` of the grid do not move
    the optimum here). Returns (coefficients of the refit best model, cv table).
    """
    features = list(features)
    grid = param_grid or SGD_GRID
    _known_keys(grid, ("alpha", "epsilon", "learning_rate", "eta0"))
    keys = list(grid)
    candidates = [dict(zip(keys, vals)) for vals in itertools.product(*[grid[k] for k in keys])]
    objectives = list(dict.fromkeys((float(c.get("alpha", 1e-4)), float(c.get("epsilon", 0.1)))
                                    for c in candidates))
    prepared, n = _prepare(df, features, target, list(order_cols or [*features, target]))
    try:
        folds = time_series_folds(n, n_splits)
        ae = [ob for ob in objectives for _ in folds]
        cuts = [tr for _ in objectives for tr, _ in folds]
        thetas, _, settled = _solve_batch(prepared, len(features), ae, cuts, max_iter)
        settled = settled.reshape(len(objectives), len(folds)).all(axis=1)
        # Score pass: MAE of each (objective, fold) model on its test rows, in one aggregate.
        th = F.array(*[F.array(*[F.lit(float(v)) for v in t]) for t in thetas])
        pred = [F.aggregate(F.zip_with(F.col("_x"), F.slice(th[m], 2, len(features)), lambda x, w: x * w),
                            F.lit(float(thetas[m][0])), lambda a, v: a + v) for m in range(len(thetas))]
        aggs = []
        for m in range(len(thetas)):
            lo, hi = folds[m % len(folds)][1]
            inside = (F.col("_pos") >= lo) & (F.col("_pos") < hi)
            aggs.append(F.avg(F.when(inside, F.abs(F.col("_y") - pred[m]))).alias(f"m{m}"))
        maes = prepared.agg(*aggs).first()
        mae = np.array([maes[f"m{m}"] if maes[f"m{m}"] is not None else np.inf for m in range(len(thetas))])
        mae = mae.reshape(len(objectives), len(folds))
        mean_mae = mae.mean(axis=1)
        rows = []
        for c in candidates:
            oi = objectives.index((float(c.get("alpha", 1e-4)), float(c.get("epsilon", 0.1))))
            rows.append((c, oi))
        scores = [mean_mae[oi] for _, oi in rows]
        best = int(np.argmin(scores))
        best_obj = objectives[rows[best][1]]
        final, _, _ = _solve_batch(prepared, len(features), [best_obj], [(0, n)], max_iter)
    finally:
        prepared.unpersist()
    ranks = pd.Series(scores).rank(method="min").astype(int).tolist()
    cv = [(str(c), float(c.get("alpha", 1e-4)), float(c.get("epsilon", 0.1)),
           *[float(x) for x in mae[oi]], float(mean_mae[oi]), int(rk), bool(settled[oi]))
          for (c, oi), rk in zip(rows, ranks)]
    spark = df.sparkSession
    fold_cols = ", ".join(f"mae_fold{i} double" for i in range(len(folds)))
    cv_df = spark.createDataFrame(cv, f"params string, alpha double, epsilon double, {fold_cols}, "
                                      "mean_mae double, rank int, converged boolean")
    return _coef_table(spark, features, final[0]), cv_df


# -- L10: random Fourier features ------------------------------------------------

class RandomFourierMap:
    """z(x) = sqrt(2/D) cos(W x + b), W ~ N(0, 2γ I), b ~ U(0, 2π) (drawn once on the driver).

    Applied inside tasks to each Arrow batch as one matrix product, so the D features
    never materialise as Spark columns.
    """

    def __init__(self, k: int, n_components: int, gamma: float, seed: int = 42):
        rng = np.random.default_rng(seed)
        self.W = rng.normal(0.0, math.sqrt(2.0 * gamma), size=(n_components, k))
        self.b = rng.uniform(0.0, 2.0 * math.pi, size=n_components)
        self.amp = math.sqrt(2.0 / n_components)
        self.names = [f"rff_{d}" for d in range(n_components)]

    def __call__(self, X: np.ndarray) -> np.ndarray:
        return self.amp * np.cos(X @ self.W.T + self.b)


def resolve_gamma(df: DataFrame, features, gamma="scale") -> float:
    """'scale' -> 1 / (k · var(X)) over all feature values; 'auto' -> 1 / k; a number as is."""
    features = list(features)
    k = len(features)
    if gamma == "scale":
        m = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(features)],
                   *[F.avg(F.col(c) * F.col(c)).alias(f"q{i}") for i, c in enumerate(features)]).first()
        mean_all = sum(m[f"m{i}"] for i in range(k)) / k
        var_all = sum(m[f"q{i}"] for i in range(k)) / k - mean_all ** 2
        return 1.0 / (k * var_all) if var_all > 0 else 1.0
    if gamma == "auto":
        return 1.0 / k
    return float(gamma)


def train_rbf_svr(df: DataFrame, features, target: str = "target", C: float = 10.0, epsilon: float = 0.1,
                  gamma="scale", n_components: int = 100, seed: int = 42, order_cols=None, max_iter: int = 60):
    """RBF-kernel SVR approximated by random Fourier features + the linear solver.

    Objective C·sum loss + ||w||²/2, i.e. alpha = 1 / (C · n) in the mean form.
    Returns (coefficients over rff_* (+ const), the feature map).
    """
    features = list(features)
    rows = df.dropna(subset=[*features, target])
    fmap = RandomFourierMap(len(features), n_components, resolve_gamma(rows, features, gamma), seed)
    prepared, n = _prepare(rows, features, target, list(order_cols or [*features, target]))
    try:
        alpha = 1.0 / (C * max(n, 1))
        thetas, _, _ = _solve_batch(prepared, n_components, [(alpha, epsilon)], [(0, n)], max_iter,
                                    featurize=fmap)
    finally:
        prepared.unpersist()
    return _coef_table(df.sparkSession, fmap.names, thetas[0]), fmap


def predict_mapped(df: DataFrame, features, fmap, coefs: DataFrame, pred: str = "pred") -> DataFrame:
    """Score rows through a feature map inside tasks (NULL feature rows get a NULL prediction)."""
    cf = {r["feature"]: r["coef"] for r in coefs.collect()}  # D + 1 numbers
    theta = np.array([cf.get(CONST, 0.0)] + [cf.get(n, 0.0) for n in fmap.names])
    features = list(features)
    out_schema = StructType([*df.schema.fields, StructField(pred, DoubleType())])

    def run(it):
        for pdf in it:
            X = pdf[features].to_numpy(dtype=np.float64)
            ok = ~np.isnan(X).any(axis=1)
            p = np.full(len(pdf), np.nan)
            if ok.any():
                p[ok] = theta[0] + fmap(X[ok]) @ theta[1:]
            pdf[pred] = p
            yield pdf

    return df.mapInPandas(run, out_schema)


def _fold_errors(prepared: DataFrame, thetas: np.ndarray, tests, featurize=None) -> np.ndarray:
    """MAE of each model over its test positions, one pass; NaN where there are none."""
    M = len(thetas)

    def run(it):
        total, count = np.zeros(M), np.zeros(M)
        for X, y, pos in (part for batch in it for part in _arrays(batch)):
            X, pos = X if featurize is None else featurize(X), pos[:, None]
            inside = (pos >= np.array([t[0] for t in tests])) & (pos < np.array([t[1] for t in tests]))
            err = np.abs(y[:, None] - thetas[:, 0] - X @ thetas[:, 1:].T)
            total += np.where(inside, err, 0.0).sum(0)
            count += inside.sum(0)
        yield _cells(np.concatenate([total, count]))

    cells = _sum_partials(prepared.mapInArrow(run, "_v array<double>"), prepared.rdd.getNumPartitions(), 2 * M)
    with np.errstate(invalid="ignore", divide="ignore"):
        return cells[:M] / cells[M:]


def kernel_grid_search(df: DataFrame, features, target: str = "target", param_grid: dict | None = None,
                       n_splits: int = 3, n_components: int = 100, seed: int = 42, order_cols=None, max_iter: int = 60):
    """Grid over kernel, C, epsilon and gamma x TimeSeriesSplit(n_splits), scored by MAE, best refit on all rows.

    Every gamma has one random Fourier map, shared by all its C, epsilon and folds, which are fitted in one batch of
    passes; 'linear' is the batch without a map, and gamma does not move it. The penalty follows the fold's own training
    rows (alpha = 1 / (C n)). Unknown grid keys and kernels raise. Returns (coefficients of the refit best model, its
    feature map or None, cv table with ``converged``). Kernel values carry an error of about 1 / sqrt(n_components).
    """
    features, grid = list(features), dict(param_grid or KERNEL_GRID)
    _known_keys(grid, ("kernel", "C", "epsilon", "gamma"))
    defaults = {"kernel": ["rbf"], "C": [10.0], "epsilon": [0.1], "gamma": ["scale"]}
    axes = {k: list(grid.get(k, v)) for k, v in defaults.items()}
    if bad := sorted(set(axes["kernel"]) - {"rbf", "linear"}):
        raise ValueError(f"Unknown kernels: {bad}")
    candidates = [dict(zip(axes, v)) for v in itertools.product(*axes.values())]
    rows = df.dropna(subset=[*features, target])
    gammas = {g: resolve_gamma(rows, features, g) for g in axes["gamma"]} if "rbf" in axes["kernel"] else {}
    maps = {None: None} | {g: RandomFourierMap(len(features), n_components, v, seed) for g, v in gammas.items()}
    prepared, n = _prepare(rows, features, target, list(order_cols or [*features, target]))
    try:
        folds, scored = time_series_folds(n, n_splits), {}
        for g, fmap in maps.items():
            mine = list(dict.fromkeys((c["C"], c["epsilon"]) for c in candidates
                                      if (None if c["kernel"] == "linear" else c["gamma"]) == g))
            if not mine:
                continue
            models = [(1.0 / (C * max(train[1] - train[0], 1)), eps) for C, eps in mine for train, _ in folds]
            width = len(features) if fmap is None else n_components
            thetas, _, settled = _solve_batch(prepared, width, models, [train for _ in mine for train, _ in folds], max_iter,
                                              featurize=fmap)
            mae = _fold_errors(prepared, thetas, [test for _ in mine for _, test in folds], fmap).reshape(-1, len(folds))
            settled = settled.reshape(-1, len(folds)).all(axis=1)
            scored |= {(g, *ce): (mae[i], bool(settled[i])) for i, ce in enumerate(mine)}
        keys = [(None if c["kernel"] == "linear" else c["gamma"], c["C"], c["epsilon"]) for c in candidates]
        means = np.array([scored[k][0].mean() for k in keys])
        best = int(np.nanargmin(means))
        g, C, eps = keys[best]
        width = len(features) if maps[g] is None else n_components
        final, _, _ = _solve_batch(prepared, width, [(1.0 / (C * max(n, 1)), eps)], [(0, n)], max_iter, featurize=maps[g])
    finally:
        prepared.unpersist()
    ranks = pd.Series(means).rank(method="min").astype(int)
    table = [(c["kernel"], float(c["C"]), float(c["epsilon"]), str(c["gamma"]), *[float(x) for x in scored[k][0]], float(m),
              int(r), scored[k][1]) for c, k, m, r in zip(candidates, keys, means, ranks)]
    fold_cols = ", ".join(f"mae_fold{i} double" for i in range(len(folds)))
    cv = df.sparkSession.createDataFrame(
        table, f"kernel string, C double, epsilon double, gamma string, {fold_cols}, mean_mae double, rank int, "
               "converged boolean")
    return _coef_table(df.sparkSession, features if maps[g] is None else maps[g].names, final[0]), maps[g], cv


# -- L11 -----------------------------------------------------------------------

def predict_linear(df: DataFrame, coefs: DataFrame, pred: str = "pred") -> DataFrame:
    from skein.operators.linear import score_linear
    return score_linear(df, coefs, [], pred=pred)


def train_and_evaluate(train: DataFrame, val: DataFrame, features, target: str = "target",
                       method: str = "sgd", **kwargs):
    """Fit on train, score train and validation, metrics for both.

    ``method``: 'sgd' (linear ε-insensitive SVR) or 'svr' (RBF via random features).
    Returns (coefficients, validation predictions, metrics table (split, mae, rmse, mape, r2, n_rows, n_null)).
    """
    features = list(features)
    if method == "sgd":
        coefs = train_linear_svr(train, features, target, **kwargs)
        tr, va = predict_linear(train, coefs), predict_linear(val, coefs)
    elif method == "svr":
        coefs, fmap = train_rbf_svr(train, features, target, **kwargs)
        tr, va = predict_mapped(train, features, fmap, coefs), predict_mapped(val, features, fmap, coefs)
    else:
        raise ValueError(f"Unknown method: {method}")
    both = tr.select(F.lit("train").alias("split"), target, "pred").unionByName(
        va.select(F.lit("validation").alias("split"), target, "pred"))
    metrics = both.groupBy("split").agg(*metric_exprs(target, "pred"), null_inputs(target, "pred"))
    return coefs, va, metrics
