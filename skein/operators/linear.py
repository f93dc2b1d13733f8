"""Linear models from one grouped Gram pass.

Fitting = ``grouped_gram`` over (features..., target) per group, then a k x k
solve per group in ``mapInPandas`` over the one-row-per-group Gram table. Models
are data: a long coefficient table ``(group..., feature, coef)`` with the intercept
under ``feature = 'const'``.

Numerics: the Gram is built from columns centred and scaled per group, so the
solve is well conditioned; coefficients are mapped back to the original scale.

* OLS (pseudo-inverse; rank-deficient groups get the minimum-norm solution in
  the standardised space, which fits the same values).
* Ridge with penalty ``alpha * ||w||²`` on the *unscaled* coefficients and an
  unpenalised intercept: in standardised space the penalty is ``alpha / scale²``.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.operators.distributions import f_sf, t_two_sided_p
from skein.operators.gram import centred, classed_gram, grouped_gram, unpack, written
from skein.operators.sizing import join_small

CONST = "const"
RCOND = 1e-10


def _group_fields(df: DataFrame, group_cols):
    by_name = {f.name: f for f in df.schema.fields}
    return [T.StructField(c, by_name[c].dataType, True) for c in group_cols]


def solve_linear(n, mean, scale, mn, mx, s, G, kf: int, alpha: float = 0.0, kind: str = "ols",
                 const_rule: bool = False, fit_intercept: bool = True):
    """Coefficients (beta, intercept, has_const) and fit statistics from one group's Gram.

    Column order of the Gram: ``kf`` features, then the target.
    """
    C = centred(n, s, G) if fit_intercept else G
    xbar = mean + scale * s / n if fit_intercept else np.zeros_like(mean)
    Cxx, cxy, cyy = C[:kf, :kf], C[:kf, kf], C[kf, kf]
    sx, sy = scale[:kf], scale[kf]
    if kind == "ols":
        P = np.linalg.pinv(Cxx, rcond=RCOND, hermitian=True) if kf else np.zeros((0, 0))
    elif kind == "ridge":
        const_col = (mn[:kf] == mx[:kf])
        pen = np.where(const_col, 1.0, alpha / (sx ** 2))
        P = np.linalg.inv(Cxx + np.diag(pen)) if kf else np.zeros((0, 0))
    else:
        raise ValueError(f"Unknown solver: {kind}")
    gamma = P @ cxy
    beta = gamma * sy / sx
    intercept = (xbar[kf] - beta @ xbar[:kf]) if fit_intercept else 0.0
    has_const, carrier = True, np.zeros(kf)
    if const_rule and kf:
        nonzero_const = (mn[:kf] == mx[:kf]) & (mn[:kf] != 0)
        if nonzero_const.any():
            v = np.where(nonzero_const, mn[:kf], 0.0)
            carrier = v / float(v @ v)
            beta = beta + intercept * carrier
            intercept, has_const = 0.0, False
    # Fit statistics (OLS algebra; for ridge they describe the penalised fit).
    sse_z = cyy - 2 * gamma @ cxy + gamma @ Cxx @ gamma
    sse = max(sse_z, 0.0) * sy ** 2
    sst = cyy * sy ** 2
    rank = int(np.linalg.matrix_rank(Cxx, tol=RCOND * max(1.0, float(np.abs(Cxx).max(initial=0.0))))) if kf else 0
    rank += 1 if fit_intercept else 0
    return {"beta": beta, "intercept": intercept, "has_const": has_const, "sse": sse, "sst": sst,
            "rank": rank, "n": n, "P": P, "sx": sx, "xbar": xbar[:kf], "sy": sy,
            "carrier": carrier}


def _fit(df: DataFrame, group_cols, features, target, kind, alpha, const_rule, with_stats, indicators=()):
    group_cols, features = list(group_cols), list(features)
    flags = [f for f in features if f in set(indicators)]
    if flags:
        features = flags + [f for f in features if f not in set(flags)]
        gram = classed_gram(df, group_cols, flags, [*features[len(flags):], target])
    else:
        cols = [*features, target]
        gram = grouped_gram(df.dropna(subset=cols), group_cols, cols)
    kf = len(features)
    gfields = _group_fields(df, group_cols)
    stat_fields = [T.StructField(n, T.DoubleType(), True) for n in
                   ("se", "t", "p_value", "r2", "adj_r2", "f_stat", "f_pvalue", "aic", "bic", "sse")]
    schema = T.StructType(gfields + [T.StructField("feature", T.StringType(), False),
                                     T.StructField("coef", T.DoubleType(), True),
                                     T.StructField("n_obs", T.LongType(), True)]
                          + (stat_fields if with_stats else []))

    def run(it):
        for pdf in it:
            out = []
            for _, row in pdf.iterrows():
                n, mean, scale, mn, mx, s, G = unpack(row, kf + 1)
                key = [row[c] for c in group_cols]
                r = solve_linear(n, mean, scale, mn, mx, s, G, kf, alpha, kind, const_rule)
                names = ([CONST] if r["has_const"] else []) + features
                coefs = ([r["intercept"]] if r["has_const"] else []) + list(r["beta"])
                stats = _inference(r) if with_stats else None
                for j, (name, coef) in enumerate(zip(names, coefs)):
                    rec = [*key, name, float(coef), int(n)]
                    if with_stats:
                        se = stats["se"][j]
                        t = coef / se if se and se > 0 else float("nan")
                        dfr = stats["df_resid"]
                        p = t_two_sided_p(t, dfr) if dfr > 0 and not math.isnan(t) else float("nan")
                        rec += [se, t, p, stats["r2"], stats["adj_r2"], stats["f"], stats["f_p"],
                                stats["aic"], stats["bic"], r["sse"]]
                    out.append(rec)
            if out:
                frame = pd.DataFrame(out, columns=[f.name for f in schema.fields])
                yield frame.replace({np.nan: None})

    return gram.mapInPandas(run, schema)


def _inference(r) -> dict:
    n, rank, sse, sst = r["n"], r["rank"], r["sse"], r["sst"]
    dfr = n - rank
    sigma2 = sse / dfr if dfr > 0 else float("nan")
    cov = sigma2 * (r["P"] / np.outer(r["sx"], r["sx"])) if r["P"].size else np.zeros((0, 0))
    # A constant column that carries the intercept has no variance of its own and takes its share of the intercept's.
    slopes = np.where(r["carrier"] != 0, 0.0, r["xbar"])
    var_b0 = sigma2 / n + (slopes @ cov @ slopes if cov.size else 0.0)
    se_beta = (np.sqrt(np.clip(np.diag(cov), 0, None) + max(var_b0, 0.0) * r["carrier"] ** 2) if cov.size
               else np.zeros(0))
    se = ([math.sqrt(max(var_b0, 0.0))] if r["has_const"] else []) + list(se_beta)
    r2 = 1.0 - sse / sst if sst > 0 else float("nan")
    adj = 1.0 - (n - 1) / dfr * (1.0 - r2) if dfr > 0 and not math.isnan(r2) else float("nan")
    dfm = rank - 1
    f = (r2 / dfm) / ((1.0 - r2) / dfr) if dfm > 0 and dfr > 0 and r2 < 1 else float("nan")
    fp = f_sf(f, dfm, dfr) if not math.isnan(f) else float("nan")
    llf = -n / 2.0 * (math.log(2 * math.pi) + math.log(sse / n) + 1.0) if sse > 0 else float("nan")
    return {"se": se, "df_resid": dfr, "r2": r2, "adj_r2": adj, "f": f, "f_p": fp,
            "aic": -2 * llf + 2 * rank, "bic": -2 * llf + math.log(n) * rank}


def fit_ols(df: DataFrame, group_cols, features, target: str = "target", const_rule: bool = True,
            indicators=()) -> DataFrame:
    """L1: OLS with intercept per group -> (group..., feature, coef, n_obs).

    ``indicators``: those of the features that are 0/1 columns of a fixed calendar. They are summed by class
    (``gram.classed_gram``) and stay out of the data pass; the coefficients are the same up to rounding.

    ``const_rule``: a group whose features include a non-zero constant column gets
    no separate intercept (the constant column carries it), as ``add_constant``
    with ``has_constant='skip'`` does.
    """
    return _fit(df, group_cols, features, target, "ols", 0.0, const_rule, False, tuple(indicators))


def ols_summary(df: DataFrame, group_cols, features, target: str = "target",
                const_rule: bool = True) -> DataFrame:
    """L2: OLS coefficients with se, t, p and model R², adj. R², F, AIC, BIC per group."""
    return _fit(df, group_cols, features, target, "ols", 0.0, const_rule, True)


def residual_tests(df: DataFrame, group_cols, features, target: str = "target", order_cols=(),
                   const_rule: bool = True) -> DataFrame:
    """L2: residual diagnostics of the OLS fit per group: (group..., n_obs, durbin_watson, skew, kurtosis, jarque_bera,
    jb_p_value).

    Durbin-Watson needs neighbours in ``order_cols`` (which should order a group's rows totally). Rows are range
    partitioned by group and order, so a large group spreads over many tasks; a task keeps one group's sums at a time and
    reports its first and last residual, and the differences across tasks follow from that small table. A group with
    residuals of zero has NULL tests.
    """
    group_cols, features, order_cols = list(group_cols), list(features), list(order_cols)
    clean = df.dropna(subset=[*features, target])
    coefs = fit_ols(clean, group_cols, features, target, const_rule)
    scored = score_linear(clean, coefs, group_cols, features, pred="_pred")
    names = [f"_g{i}" for i in range(len(group_cols))]
    rows = scored.select(*[F.col(c).alias(n) for c, n in zip(group_cols, names)], *order_cols,
                         (F.col(target).cast("double") - F.col("_pred")).alias("_e"))
    keys = [F.col(c).asc_nulls_last() for c in [*names, *order_cols]]
    if keys:
        rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = rows.select(*names, "_e", F.spark_partition_id().alias("_part"))
    parts_schema = T.StructType([T.StructField(n, df.schema[c].dataType) for c, n in zip(group_cols, names)] + [
        T.StructField("_part", T.IntegerType()), T.StructField("_n", T.LongType())] + [
        T.StructField(c, T.DoubleType()) for c in ("_s1", "_s2", "_s3", "_s4", "_d2", "_first", "_last")])
    parts = rows.mapInPandas(_residual_sums(names), parts_schema)
    order = (Window.partitionBy(*names) if names else Window.partitionBy()).orderBy("_part")
    across = F.coalesce(F.pow(F.col("_first") - F.lag("_last").over(order), F.lit(2)), F.lit(0.0))
    total = parts.withColumn("_d2", F.col("_d2") + across).groupBy(*names).agg(
        F.sum("_n").alias("n_obs"), *[F.sum(c).alias(c) for c in ("_s1", "_s2", "_s3", "_s4", "_d2")])
    n, mean = F.col("n_obs"), F.col("_s1") / F.col("n_obs")
    raw = [F.col(f"_s{i}") / n for i in (2, 3, 4)]
    m2 = raw[0] - mean * mean
    m3 = raw[1] - 3 * mean * raw[0] + 2 * F.pow(mean, F.lit(3))
    m4 = raw[2] - 4 * mean * raw[1] + 6 * mean * mean * raw[0] - 3 * F.pow(mean, F.lit(4))
    out = total.withColumn("skew", F.when(m2 > 0, m3 / F.pow(m2, F.lit(1.5)))).withColumn(
        "kurtosis", F.when(m2 > 0, m4 / (m2 * m2))).withColumn("durbin_watson", F.when(F.col("_s2") > 0, F.col("_d2") / F.col("_s2")))
    jb = n / 6.0 * (F.col("skew") * F.col("skew") + F.pow(F.col("kurtosis") - 3, F.lit(2)) / 4)
    return out.select(*[F.col(x).alias(c) for c, x in zip(group_cols, names)], "n_obs", "durbin_watson", "skew", "kurtosis",
                      jb.alias("jarque_bera"), F.exp(-jb / 2).alias("jb_p_value"))


def _residual_sums(names):
    """Of each task's sorted rows, per group: count, power sums of the residual, squared differences of neighbours, and
    the first and last residual."""
    columns = [*names, "_part", "_n", "_s1", "_s2", "_s3", "_s4", "_d2", "_first", "_last"]

    def run(it):
        now = key = None
        for pdf in it:
            codes = pdf[names].apply(tuple, axis=1).tolist() if names else [()] * len(pdf)
            e_all, part = pdf["_e"].to_numpy(dtype=np.float64), int(pdf["_part"].iloc[0]) if len(pdf) else 0
            cut = [i for i in range(len(codes)) if not i or not _same(codes[i], codes[i - 1])]
            for lo, hi in zip(cut, [*cut[1:], len(codes)]):
                e = e_all[lo:hi]
                sums = [hi - lo, *[(e ** p).sum() for p in (1, 2, 3, 4)], (np.diff(e) ** 2).sum()]
                if now is not None and _same(codes[lo], key):
                    sums[-1] += (e[0] - now[-1]) ** 2
                    now = [a + b for a, b in zip(now[:6], sums)] + [now[6], e[-1]]
                else:
                    if now is not None:
                        yield pd.DataFrame([[*key, part, *now]], columns=columns)
                    key, now = codes[lo], [*sums, e[0], e[-1]]
        if now is not None:
            yield pd.DataFrame([[*key, part, *now]], columns=columns)

    return run


def _same(a: tuple, b: tuple) -> bool:
    return all(x == y or (pd.isna(x) and pd.isna(y)) for x, y in zip(a, b))


def fit_ridge(df: DataFrame, group_cols, features, target: str = "target", alpha: float = 1.0) -> DataFrame:
    """L4: Ridge (penalty alpha * ||w||², features not scaled, intercept free) per group."""
    return _fit(df, group_cols, features, target, "ridge", float(alpha), False, False)


def fit_ridge_pooled(df: DataFrame, market: str, features, target: str = "target", alpha: float = 1.0,
                     categories=None) -> DataFrame:
    """One Ridge over all markets with a dummy ``market_{v}`` for each -> (feature, coef, n_obs).

    No dummy column is built: given the slopes w and the intercept b0, a market's dummy is
    d = n / (n + alpha) * (mean(y) - b0 - mean(x) w), so the dummies are eliminated from the normal equations. What is
    left is a k x k system: the cross-products within markets plus those of the market means, weighted by
    h = n * alpha / (n + alpha). One Gram pass by market gives both, a partial sum per task brings them together, and the
    dummies follow from the Gram table row by row, so any number of markets is a table.

    Rows whose market is null (or not in ``categories``, where given) have no dummy; a category without rows has a
    dummy of 0, as penalised least squares gives it. ``alpha=0`` takes the limit of small penalties. No rows, no
    coefficients.
    """
    features = list(features)
    kf, cols = len(features), [*features, target]
    known = F.col(market).isNotNull()
    if categories is not None:
        known = known & F.col(market).isin(list(categories))
    keyed = df.dropna(subset=cols).select(
        known.alias("_dummy"), F.when(known, F.col(market).cast("string")).otherwise("").alias("_market"), *cols)
    gram = written(grouped_gram(keyed, ["_dummy", "_market"], cols))
    sums = gram.mapInPandas(_pooled_sums(kf, alpha), "n long, h double, mean array<double>, within array<double>, between array<double>")
    w, b0, n_obs = _pooled_solution([r.asDict() for r in sums.collect()], kf, alpha)  # one row for each task
    spark = df.sparkSession
    schema = "feature string, coef double, n_obs long"
    if not n_obs:
        return spark.createDataFrame([], schema)
    shared = spark.createDataFrame([(n, float(v), n_obs) for n, v in zip([CONST, *features], [b0, *w])], schema)
    gap = F.col("mean")[kf] - F.lit(float(b0))
    for i, v in enumerate(w):
        gap = gap - F.col("mean")[i] * F.lit(float(v))
    dummies = gram.where("_dummy").select(F.concat(F.lit(f"{market}_"), "_market").alias("feature"),
                                          (F.col("n") / (F.col("n") + F.lit(float(alpha))) * gap).alias("coef"),
                                          F.lit(n_obs).alias("n_obs"))
    if categories is not None:
        names = spark.createDataFrame([(f"{market}_{v}",) for v in categories], "feature string")
        dummies = names.join(dummies, "feature", "left").select(
            "feature", F.coalesce("coef", F.lit(0.0)).alias("coef"), F.lit(n_obs).alias("n_obs"))
    return shared.unionByName(dummies)


def _pooled_sums(kf: int, alpha: float):
    """Of a task's Gram rows: cross-products within markets, and the weighted mean and cross-products of the market
    means. Rows without a dummy weigh n, markets n / (n + alpha) times the penalty (times 1 where that is 0)."""
    def run(it):
        n_all, h_all, mean, within, between = 0, 0.0, np.zeros(kf + 1), np.zeros((kf + 1,) * 2), np.zeros((kf + 1,) * 2)
        for pdf in it:
            for _, row in pdf.iterrows():
                n, m, scale, _, _, s, G = unpack(row, kf + 1)
                m = m + scale * s / n
                within += centred(n, s, G) * np.outer(scale, scale)
                h = n * (alpha or 1e-9) / (n + alpha) if row["_dummy"] else float(n)
                d = m - mean
                between += np.outer(d, d) * (h_all * h / (h_all + h))
                mean, h_all, n_all = mean + d * (h / (h_all + h)), h_all + h, n_all + n
        if n_all:
            yield pd.DataFrame({"n": [n_all], "h": [h_all], "mean": [mean], "within": [within.ravel()],
                                "between": [between.ravel()]})

    return run


def _pooled_solution(parts: list[dict], kf: int, alpha: float):
    """Slopes, intercept and row count from the tasks' sums."""
    if not parts:
        return np.zeros(0), 0.0, 0
    h_all, mean = 0.0, np.zeros(kf + 1)
    within, between = np.zeros((kf + 1,) * 2), np.zeros((kf + 1,) * 2)
    for r in parts:
        d, h = np.array(r["mean"]) - mean, r["h"]
        within += np.array(r["within"]).reshape(within.shape)
        between += np.array(r["between"]).reshape(within.shape) + np.outer(d, d) * (h_all * h / (h_all + h))
        mean, h_all = mean + d * (h / (h_all + h)), h_all + h
    C = within + between
    size = np.sqrt(np.where(np.diag(C)[:kf] > 0, np.diag(C)[:kf], 1.0))  # scaled, so that ranks are told safely
    A = C[:kf, :kf] / np.outer(size, size) + np.diag(alpha / size ** 2)
    rhs = C[:kf, kf] / size
    w = (np.linalg.solve(A, rhs) if alpha > 0 else np.linalg.pinv(A, rcond=RCOND, hermitian=True) @ rhs) / size
    return w, float(mean[kf] - mean[:kf] @ w), int(sum(r["n"] for r in parts))


def score_pooled(df: DataFrame, coefs: DataFrame, market: str, features, pred: str = "pred") -> DataFrame:
    """Predictions of ``fit_ridge_pooled``'s model: shared coefficients as literals, a market's dummy by a lookup. A null
    market, or one without a dummy, adds nothing."""
    features = list(features)
    shared = coefs.where(F.col("feature").isin([CONST, *features]))
    key = fresh_name(df, "dummy_of")
    dummies = coefs.where(~F.col("feature").isin([CONST, *features])).select(
        F.col("feature").alias(key), F.col("coef").alias(f"{key}_coef"))
    named = df.withColumn(key, F.concat(F.lit(f"{market}_"), F.col(market).cast("string")))
    scored = score_linear(join_small(named, dummies, [key], how="left"), shared, [], features, pred)
    return scored.withColumn(pred, F.col(pred) + F.coalesce(f"{key}_coef", F.lit(0.0))).select(*df.columns, pred)


def fresh_name(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores before it as make it new among the columns of ``df``."""
    while any(c.lower().startswith(name) for c in df.columns):
        name = f"_{name}"
    return name


def coef_wide(coefs: DataFrame, group_cols, features) -> DataFrame:
    """Coefficient table to one row per group: group..., _c_const, _c_<feature>... (small)."""
    names = [CONST, *features]
    aggs = [F.max(F.when(F.col("feature") == n, F.col("coef"))).alias(f"_c_{n}") for n in names]
    if group_cols:
        return coefs.groupBy(*group_cols).agg(*aggs, F.lit(True).alias("_modelled"))
    return coefs.agg(*aggs, F.lit(True).alias("_modelled"))


def score_linear(df: DataFrame, coefs: DataFrame, group_cols, features=None, pred: str = "pred") -> DataFrame:
    """Const + sum coalesce(x, 0) * coef; absent const or feature -> 0;
    a row whose group has no model gets a NULL prediction.
    """
    group_cols = list(group_cols)
    if features is None:
        names = [r[0] for r in coefs.select("feature").distinct().collect()]
        features = sorted(n for n in names if n != CONST)
    features = list(features)
    wide = coef_wide(coefs, group_cols, features)
    have = set(df.columns)
    if group_cols:
        j = join_small(df, wide, group_cols, how="left")

        def coef(name):
            return F.coalesce(F.col(f"_c_{name}"), F.lit(0.0))
        modelled = F.col("_modelled")
    else:
        # A pooled model is one row of k numbers: inline it as literals.
        row = wide.first()
        j = df

        def coef(name):
            v = row[f"_c_{name}"] if row is not None else None
            return F.lit(float(v) if v is not None else 0.0)
        modelled = F.lit(row is not None)
    total = coef(CONST)
    for f in features:
        x = F.coalesce(F.col(f).cast("double"), F.lit(0.0)) if f in have else F.lit(0.0)
        total = total + x * coef(f)
    return j.select(*df.columns, F.when(modelled, total).alias(pred))


def unmodelled_report(df: DataFrame, coefs: DataFrame, group_cols) -> DataFrame:
    """Groups present in ``df`` without a model, with their row counts (J3 / L7 report)."""
    have = coefs.select(*group_cols).distinct()
    return (df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("n_rows"))
            .join(have, list(group_cols), "left_anti"))


def fit_predict_exog(train: DataFrame, test: DataFrame, market: str, exog, target: str = "target",
                     alpha: float = 1.0, id_col: str = "id"):
    """Exogenous-only Ridge per market on all training rows; predictions for the test rows.

    Returns (predictions (id, market, pred), coefficients, report of unmodelled markets).
    """
    exog = list(exog)
    coefs = fit_ridge(train, [market], exog, target, alpha)
    scored = score_linear(test, coefs, [market], exog)
    report = unmodelled_report(test, coefs, [market])
    return scored.select(id_col, market, "pred"), coefs, report
