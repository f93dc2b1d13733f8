"""Feature selection.

The heavy part of each method is one distributed pass (correlations, Gram
matrices, forest training); the decisions run on k x k matrices on the driver.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.operators.forest import forest_importance
from skein.operators.gram import centred, grouped_gram, unpack, written
from skein.operators.positions import with_positions
from skein.operators.stats import corr_long

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


# -- X1 -----------------------------------------------------------------------

def correlation_filter(df: DataFrame, target_col: str = "target", threshold: float = 0.05,
                       inter_threshold: float = 0.95, cols=None):
    """Drop features weakly correlated with the target, then one of each collinear pair.

    Returns (kept, dropped, corr) where ``corr`` is the long (f1, f2, corr) table.
    A feature whose correlation with the target is undefined is neither weak nor kept.
    Collinear pairs are scanned i < j over the kept list; the one less correlated with
    the target goes (ties keep the first); a dropped f1 still removes later features.
    """
    numeric = list(cols or numeric_columns(df))
    if target_col not in numeric:
        raise ValueError(f"{target_col} not in numeric columns")
    corr_df = corr_long(df, numeric)
    status = _correlation_status(corr_df, [c for c in numeric if c != target_col], target_col, threshold, inter_threshold)
    kept = [f for f, (s, _) in status.items() if s == "kept"]
    dropped = [f for want in ("weak", "collinear") for f, (s, _) in status.items() if s == want]
    return kept, dropped, corr_df


def _correlation_status(corr_df: DataFrame, feats, target_col, threshold, inter_threshold) -> dict:
    """feature -> (status, |corr with the target|), from the k x k matrix of absolute correlations.

    The strong features' collinearity is a boolean adjacency matrix over their list order. A pass over its rows marks,
    for each row still standing, the standing later columns it outranks (or ties with); the row itself is marked
    once a standing later column outranks it, without sparing the columns behind.
    """
    place = {f: i for i, f in enumerate([*feats, target_col])}
    matrix = np.full((len(place), len(place)), np.nan)
    for r in corr_df.collect():  # k² values
        if r["corr"] is not None and r["f1"] in place and r["f2"] in place:
            matrix[place[r["f1"]], place[r["f2"]]] = abs(r["corr"])
    to_target = matrix[:-1, -1]
    strong = np.flatnonzero(to_target >= threshold)
    strength = to_target[strong]
    tied = np.triu(matrix[np.ix_(strong, strong)] > inter_threshold, 1)
    loses = strength[None, :] <= strength[:, None]  # [i, j]: j goes rather than i
    standing = np.ones(len(strong), bool)
    for i in range(len(strong)):
        if standing[i]:
            rivals = tied[i] & standing
            standing &= ~(rivals & loses[i])
            standing[i] = not (rivals & ~loses[i]).any()
    label = np.where(np.isnan(to_target), "undefined", "weak").astype(object)
    label[strong] = np.where(standing, "kept", "collinear")
    return {f: (label[i], None if np.isnan(to_target[i]) else float(to_target[i])) for i, f in enumerate(feats)}


def correlation_filter_table(df: DataFrame, target_col: str = "target", threshold: float = 0.05,
                             inter_threshold: float = 0.95, cols=None) -> DataFrame:
    """X1 as a table: (feature, status, abs_corr_target); status kept / weak / collinear / undefined."""
    numeric = list(cols or numeric_columns(df))
    corr_df = corr_long(df, numeric)
    status = _correlation_status(corr_df, [c for c in numeric if c != target_col], target_col, threshold, inter_threshold)
    rows = [(f, s, v) for f, (s, v) in status.items()]
    return df.sparkSession.createDataFrame(rows, "feature string, status string, abs_corr_target double")


# -- X2 -----------------------------------------------------------------------

def _vifs(G: np.ndarray) -> np.ndarray:
    """VIF_i = 1 / (1 - R²_i), R²_i uncentred (no constant) from the uncentred Gram."""
    k = G.shape[0]
    out = np.empty(k)
    for i in range(k):
        o = [j for j in range(k) if j != i]
        gii = G[i, i]
        if gii <= 0:
            out[i] = np.inf
            continue
        if o:
            Goo = G[np.ix_(o, o)]
            gio = G[i, o]
            ssr = gii - gio @ np.linalg.pinv(Goo, rcond=1e-12, hermitian=True) @ gio
        else:
            ssr = gii
        out[i] = np.inf if ssr <= gii * 1e-12 else gii / ssr
    return out


def vif_table(df: DataFrame, features) -> DataFrame:
    """VIF of each feature on the rows complete in ``features`` (one uncentred Gram pass)."""
    features = list(features)
    rows = df.dropna(subset=features)
    g = grouped_gram(rows, [], features, center=False).first()
    if g is None:
        return df.sparkSession.createDataFrame([], "feature string, vif double")
    n, mean, scale, mn, mx, s, G = unpack(g, len(features))
    v = _vifs(G)
    return df.sparkSession.createDataFrame([(f, float(x)) for f, x in zip(features, v)], "feature string, vif double")


def null_pattern_grams(df: DataFrame, features) -> DataFrame:
    """``pattern, n, cells``: for each pattern of missing values (a string of one digit a feature, 1 where it is missing)
    its rows and the uncentred cross-products of its rows, missing values as 0. The rows are read once; the Gram of the
    rows that are complete in any subset of the features is the sum over the patterns without a 1 in the subset."""
    features = list(features)
    k = len(features)
    absent = [F.col(c).isNull() | F.isnan(F.col(c).cast("double")) for c in features]
    rows = df.select(F.concat(*[F.when(a, "1").otherwise("0") for a in absent]).alias("pattern"),
                     *[F.when(a, 0.0).otherwise(F.col(c).cast("double")).alias(c) for a, c in zip(absent, features)])
    g = grouped_gram(rows, ["pattern"], features, center=False)
    cells = F.transform("g", lambda v, i: v * F.col("scale")[F.floor(i / k).cast("int")] * F.col("scale")[(i % k).cast("int")])
    return written(g.select("pattern", "n", cells.alias("cells")))


def _subset_gram(patterns: DataFrame, k: int, subset: list[int]) -> np.ndarray | None:
    """The Gram of the ``subset`` of ``k`` features over the rows complete in it; None where there are no such rows."""
    whole = patterns
    for i in subset:
        whole = whole.where(F.substring("pattern", i + 1, 1) == "0")
    cells = whole.select(F.posexplode("cells").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect()  # k²
    if not cells:
        return None
    G = np.zeros(k * k)
    for r in cells:
        G[r["i"]] = r["v"]
    return G.reshape(k, k)[np.ix_(subset, subset)]


def vif_filter(df: DataFrame, features, vif_threshold: float = 10.0) -> list[str]:
    """Drop the feature with the highest VIF until every VIF <= threshold.

    Each round uses the rows complete in the *remaining* columns; its Gram is a sum over the table of null patterns, so
    the rows are read once however many rounds there are.
    """
    features = list(features)
    patterns = null_pattern_grams(df, features)
    missing = patterns.agg(*[F.max(F.substring("pattern", i + 1, 1)).alias(f"m{i}") for i in range(len(features))]).first()
    remaining, G = list(range(len(features))), None
    while len(remaining) > 1:
        if G is None:
            G = _subset_gram(patterns, len(features), remaining)
            if G is None:
                break
        v = _vifs(G)
        worst = int(np.argmax(v))
        if not (v[worst] > vif_threshold):
            break
        gone = remaining.pop(worst)
        # without missing values in the dropped feature the remaining rows are the same
        G = None if missing[gone] == "1" else np.delete(np.delete(G, worst, 0), worst, 1)
    return [features[i] for i in remaining]


# -- X3 -----------------------------------------------------------------------

def rf_importance(df: DataFrame, features, target_col: str = "target", n_estimators: int = 200,
                  max_depth: int = 12, seed: int = 42, top_k: int | None = None) -> DataFrame:
    """Random-forest impurity importances (every feature considered at each split).

    (feature, importance) sorted descending; ``top_k`` keeps the first k. Continuous features are binned, as MLlib does
    it, so values differ from an exact-split forest; the ranking is the product.
    """
    features = list(features)
    imp = forest_importance(df, features, target_col, n_estimators, max_depth, seed)
    rows = sorted(zip(features, (float(x) for x in imp)), key=lambda t: (-t[1], features.index(t[0])))
    if top_k is not None:
        rows = rows[:top_k]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


# -- X4 -----------------------------------------------------------------------

def _cd_lasso(A: np.ndarray, c: np.ndarray, lam: np.ndarray, w0: np.ndarray, tol: float = 1e-10,
              max_iter: int = 10_000) -> np.ndarray:
    """Coordinate descent for 1/2 wᵀAw - cᵀw + sum lam_j |w_j| (A = XᵀX/n, c = Xᵀy/n)."""
    w = w0.copy()
    k = len(c)
    for _ in range(max_iter):
        delta = 0.0
        for j in range(k):
            ajj = A[j, j]
            if ajj <= 0:
                if w[j] != 0:
                    delta = max(delta, abs(w[j]))
                w[j] = 0.0
                continue
            rho = c[j] - A[j] @ w + ajj * w[j]
            new = math.copysign(max(abs(rho) - lam[j], 0.0), rho) / ajj
            delta = max(delta, abs(new - w[j]))
            w[j] = new
        if delta < tol:
            break
    return w


def kfold_index(pos, n, folds: int = 5):
    """Contiguous unshuffled folds: the first n % folds folds hold one extra row."""
    q, r = divmod(n, folds)
    big = r * (q + 1)
    return F.when(pos < F.lit(big), F.floor(pos / F.lit(q + 1))).otherwise(
        F.lit(r) + F.floor((pos - F.lit(big)) / F.lit(max(q, 1)))).cast("int")


def lasso_cv(df: DataFrame, features, target_col: str = "target", order_cols=None, folds: int = 5,
             n_alphas: int = 100, eps: float = 1e-3):
    """LassoCV with contiguous folds over rows in ``order_cols`` order.

    One Gram pass grouped by fold (all columns standardised with the same global
    shift/scale); training Gram of a fold = total - fold. Path of ``n_alphas`` values
    from alpha_max down to eps * alpha_max; best alpha by mean test MSE; refit on all.
    Returns (selected features, coefficient table (feature, coef), alpha).
    """
    features = list(features)
    k = len(features)
    cols = [*features, target_col]
    order_cols = list(order_cols or cols)
    rows = df.select(*dict.fromkeys([*order_cols, *cols])).dropna(subset=cols)
    ranked = with_positions(rows, [], order_cols, pos_col="_pos", count_col="_n")
    n = rows.count()
    if n < folds:
        raise ValueError("fewer rows than folds")
    framed = ranked.withColumn("_fold", kfold_index(F.col("_pos"), n, folds))
    mom = rows.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                   *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    shift = np.array([mom[f"m{i}"] for i in range(len(cols))], float)
    scale = np.array([mom[f"s{i}"] or 1.0 for i in range(len(cols))], float)
    scale[scale == 0] = 1.0
    gram_rows = grouped_gram(framed, ["_fold"], cols, fixed=(shift, scale)).collect()
    per = {r["_fold"]: unpack(r, k + 1) for r in gram_rows}
    tot_n = sum(v[0] for v in per.values())
    tot_s = sum(v[5] for v in per.values())
    tot_G = sum(v[6] for v in per.values())
    sx, sy = scale[:k], scale[k]

    def problem(nn, ss, GG):
        C = centred(nn, ss, GG)
        return C[:k, :k] / nn, C[:k, k] / nn, ss / nn

    A_all, c_all, _ = problem(tot_n, tot_s, tot_G)
    alpha_max = float(np.max(np.abs(c_all) * sx * sy)) if k else 0.0
    alphas = np.logspace(np.log10(alpha_max * eps), np.log10(alpha_max), n_alphas)[::-1] if alpha_max > 0 \
        else np.array([0.0])
    mse = np.zeros((len(per), len(alphas)))
    for fi, (f, (nf, _, _, _, _, sf, Gf)) in enumerate(sorted(per.items())):
        A, c, zbar = problem(tot_n - nf, tot_s - sf, tot_G - Gf)
        w = np.zeros(k)
        for ai, a in enumerate(alphas):
            lam = a / (sy * sx)
            w = _cd_lasso(A, c, lam, w)
            b = zbar[k] - zbar[:k] @ w
            # Test SSE from the fold's own sums of z and z zᵀ.
            Syy, Sy, Sxy, Sx, Sxx = Gf[k, k], sf[k], Gf[:k, k], sf[:k], Gf[:k, :k]
            sse = (Syy - 2 * b * Sy - 2 * w @ Sxy + nf * b * b + 2 * b * (w @ Sx) + w @ Sxx @ w)
            mse[fi, ai] = max(sse, 0.0) / nf * sy * sy
    best = int(np.argmin(mse.mean(axis=0)))
    alpha = float(alphas[best])
    w = _cd_lasso(A_all, c_all, alpha / (sy * sx), np.zeros(k))
    coef = w * sy / sx
    selected = [f for f, v in zip(features, coef) if abs(v) > 0]
    table = df.sparkSession.createDataFrame([(f, float(v)) for f, v in zip(features, coef)],
                                            "feature string, coef double")
    return selected, table, alpha
