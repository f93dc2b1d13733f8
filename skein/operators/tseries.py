"""Time-series operators per market (T1-T6) on Gram passes.

* ADF (T1/T2): Δy_t on const, y_{t-1}, Δy_{t-1..t-p}. Lag columns come from one
  window pass; one grouped Gram over the common sample gives every candidate p's
  SSR from nested sub-blocks (AIC choice); a second pass refits at the chosen p on
  all rows available to it. p-value: MacKinnon (1994) approximation, constant case.
* T3: difference the markets the test calls non-stationary.
* T4: VAR lag-order table (AIC, BIC, HQIC, FPE) from one Gram of all lags.
* T5: conditional least squares VARX per market (re-aimed from a state-space fit),
  one Gram pass, coefficient table + status per market.
* T6: multi-step forecast: exogenous part scored per row in parallel, then a native
  ``aggregate`` fold over each market's horizon rows (at most ``FORECAST_BLOCK`` steps), or, for horizons without such
  a bound, blocks of rows joined by powers of the companion matrix.

Solves run in tasks, one Gram row for a market (``_solve_rows``); the driver sees one number, the longest lag.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.operators.distributions import norm_cdf
from skein.operators.gram import centred, grouped_gram, unpack
from skein.operators.linear import RCOND, solve_linear
from skein.operators.positions import with_positions
from skein.operators.sizing import join_small
from skein.operators.windows import window_features
from skein.session import ensure_checkpoint_dir
from skein.spec import PanelSpec

# -- MacKinnon (1994) approximate p-value, regression with constant, one series. ---
# Fixed values of the published table (case "c", N = 1).
ADF_TAU_MAX = 2.74
ADF_TAU_MIN = -18.83
ADF_TAU_STAR = -1.61
ADF_SMALLP = (2.1659, 1.4412, 0.038269)
ADF_LARGEP = (1.7339, 0.93202, -0.12745, -0.010368)


def mackinnon_p(tau: float) -> float:
    if tau is None or math.isnan(tau):
        return float("nan")
    if tau > ADF_TAU_MAX:
        return 1.0
    if tau < ADF_TAU_MIN:
        return 0.0
    coefs = ADF_SMALLP if tau <= ADF_TAU_STAR else ADF_LARGEP
    return norm_cdf(sum(c * tau ** i for i, c in enumerate(coefs)))


def _f(x):
    """Python float or None (numpy scalars and NaN are not accepted by createDataFrame)."""
    if x is None:
        return None
    x = float(x)
    return None if math.isnan(x) else x


def adf_maxlag(n: int) -> int:
    return min(int(math.ceil(12.0 * (n / 100.0) ** 0.25)), n // 2 - 2)


def _sub(stats, idx):
    n, mean, scale, mn, mx, s, G = stats
    idx = np.asarray(idx)
    return n, mean[idx], scale[idx], mn[idx], mx[idx], s[idx], G[np.ix_(idx, idx)]


def _ols_sub(stats, feat_idx, y_idx):
    sub = _sub(stats, [*feat_idx, y_idx])
    return solve_linear(*sub, kf=len(feat_idx), kind="ols")


def _lag_frame(df: DataFrame, spec: PanelSpec, col: str, max_lag: int, **window_kw) -> DataFrame:
    """y, y_{t-1}, Δy_t and Δy_{t-j} (j = 1..max_lag) as columns; all from lags of y."""
    lagged = window_features(df, spec, lags={col: list(range(1, max_lag + 2))}, **window_kw)
    y = lambda j: F.col(col) if j == 0 else F.col(f"{col}_lag_{j}h")
    return lagged.select(
        spec.market, spec.time, spec.id,
        y(1).alias("_ylag"), (y(0) - y(1)).alias("_dy"),
        *[(y(j) - y(j + 1)).alias(f"_dl{j}") for j in range(1, max_lag + 1)],
        F.array(*[y(j) for j in range(1, max_lag + 2)]).alias("_ylags"))


def adf_by_market(df: DataFrame, spec: PanelSpec = PanelSpec(), col: str | None = None,
                  significance: float = 0.05, fixed_lag: int | None = None, **window_kw) -> DataFrame:
    """(market, adf_stat, p_value, used_lag, n_obs, stationary) per market.

    Lag order by AIC over 0..maxlag on a common sample (``fixed_lag`` skips the search).
    """
    col = col or spec.target
    series = df.where(F.col(spec.market).isNotNull() & F.col(col).isNotNull())
    n = F.col("_rows")
    by_size = F.least(F.ceil(12.0 * F.pow(n / 100.0, F.lit(0.25))), F.floor(n / 2) - 2).cast("int")
    lags = series.groupBy(spec.market).agg(F.count(F.lit(1)).alias("_rows")).withColumn("_ml", by_size).where("_ml >= 0")
    if fixed_lag is not None:
        lags = lags.withColumn("_ml", F.lit(int(fixed_lag)))
    lags = lags.select(spec.market, "_ml")
    L = lags.agg(F.max("_ml")).first()[0]
    if L is None:
        return df.sparkSession.createDataFrame([], f"{_typed(df, spec)}, {_ADF}")
    frame = _lag_frame(series, spec, col, L, **window_kw)
    cols = ["_ylag", *[f"_dl{j}" for j in range(1, L + 1)], "_dy"]

    def gram_of(table: DataFrame, last: str) -> DataFrame:
        """Gram of each market's rows that have all lags up to its ``last``; columns beyond are zero there, outside every
        block that the market uses."""
        rows = join_small(frame, table, [spec.market]).where(F.element_at("_ylags", F.col(last) + 1).isNotNull())
        zeroed = [F.when(F.lit(j) <= F.col(last), F.col(f"_dl{j}")).otherwise(F.lit(0.0)).alias(f"_dl{j}")
                  for j in range(1, L + 1)]
        return join_small(grouped_gram(rows.select(spec.market, "_ylag", *zeroed, "_dy"), [spec.market], cols),
                          table, [spec.market])

    best = lags.withColumnRenamed("_ml", "_bl")
    if fixed_lag is None:
        def choose(row):
            return [(row[spec.market], _aic_order(unpack(row, L + 2), int(row["_ml"])))]
        best = _solve_rows(gram_of(lags, "_ml"), f"{_typed(df, spec)}, _bl int", choose)

    def test(row):
        stats, p = unpack(row, L + 2), int(row["_bl"])
        r = _ols_sub(stats, list(range(0, p + 1)), L + 1)
        n, dfr = r["n"], r["n"] - r["rank"]
        sigma2 = r["sse"] / dfr if dfr > 0 else float("nan")
        se = math.sqrt(max(sigma2 * r["P"][0, 0] / r["sx"][0] ** 2, 0.0)) if dfr > 0 else float("nan")
        tau = float(r["beta"][0] / se) if se and se > 0 else float("nan")
        pv = mackinnon_p(tau)
        return [(row[spec.market], _f(tau), _f(pv), p, int(n), bool(pv < significance) if not math.isnan(pv) else None)]

    return _solve_rows(gram_of(best, "_bl"), f"{_typed(df, spec)}, {_ADF}", test)


_ADF = "adf_stat double, p_value double, used_lag int, n_obs long, stationary boolean"


def _typed(df: DataFrame, spec: PanelSpec) -> str:
    return f"`{spec.market}` {df.schema[spec.market].dataType.simpleString()}"


def _solve_rows(gram: DataFrame, schema: str, solve) -> DataFrame:
    """``solve(row)`` of every Gram row, in tasks: a market's solve never reaches the driver. The result is small (a few
    rows for each market) and checkpointed, so that later plans read it instead of solving again."""
    ensure_checkpoint_dir(gram.sparkSession)
    names = T._parse_datatype_string(schema).names

    def run(it):
        for pdf in it:
            out = [rec for row in pdf.to_dict("records") for rec in solve(row)]
            if out:
                yield pd.DataFrame(out, columns=names).astype(object).where(lambda x: x.notna(), None)

    return gram.mapInPandas(run, schema).checkpoint(eager=True)


def nested_factor(C: np.ndarray, k: int) -> np.ndarray:
    """Cholesky factor of a centred Gram, grown column by column over the first ``k`` columns. Row i's entries up to column
    j tell what the first j + 1 columns explain of column i: its remaining sum of squares is C[i, i] - sum of their squares,
    so one factor serves every nested order. A column that the ones before explain is skipped (a zero column)."""
    m = len(C)
    out = np.zeros((m, k))
    for j in range(k):
        rest = C[j:, j] - out[j:, :j] @ out[j, :j]
        if rest[0] > RCOND * max(C[j, j], 1e-300):
            out[j:, j] = rest / math.sqrt(rest[0])
    return out


def _aic_order(stats, ml: int) -> int:
    """Lag order of smallest AIC over 0..ml on one sample, from one factor of all lags."""
    n, _, scale, _, _, s, G = stats
    used = [*range(ml + 1), len(s) - 1]
    C = centred(n, s, G)[np.ix_(used, used)]
    left = np.maximum(C[-1, -1] - np.cumsum(nested_factor(C, ml + 1)[-1] ** 2), 0.0) * scale[-1] ** 2
    aic = [n * math.log(v / n) + n * (1 + math.log(2 * math.pi)) + 2 * (p + 2) if v > 0 else -math.inf
           for p, v in enumerate(left)]
    return int(np.argmin(aic))


def difference_if_needed(df: DataFrame, spec: PanelSpec = PanelSpec(), col: str | None = None,
                         significance: float = 0.05, **window_kw) -> DataFrame:
    """Per market, the series itself if stationary, else its first difference (first row dropped).

    Output: market, time, id, value, differenced.
    """
    col = col or spec.target
    tests = adf_by_market(df, spec, col, significance, **window_kw).select(
        spec.market, F.coalesce(~F.col("stationary"), F.lit(True)).alias("differenced"))
    series = df.where(F.col(spec.market).isNotNull() & F.col(col).isNotNull())
    diffed = window_features(series, spec, diffs=[col], **window_kw)
    j = join_small(diffed, tests, [spec.market])
    value = F.when(F.col("differenced"), F.col(f"{col}_diff")).otherwise(F.col(col))
    return j.select(spec.market, spec.time, spec.id, value.alias("value"), "differenced").where(
        F.col("value").isNotNull())


# -- T4 ------------------------------------------------------------------------

def _lag_block(df: DataFrame, spec: PanelSpec, endog, maxlags: int, **window_kw):
    lagged = window_features(df, spec, lags={c: list(range(1, maxlags + 1)) for c in endog}, **window_kw)
    lag_cols = [f"{c}_lag_{p}h" for p in range(1, maxlags + 1) for c in endog]  # lag-major
    return lagged, lag_cols


def select_lag_order(df: DataFrame, spec: PanelSpec = PanelSpec(), endog=None, maxlags: int = 24,
                     **window_kw) -> DataFrame:
    """T4: (market, p, aic, bic, hqic, fpe) for p = 0..maxlags on the same sample."""
    endog = list(endog or [spec.target])
    k = len(endog)
    series = df.where(F.col(spec.market).isNotNull()).dropna(subset=endog)
    lagged, lag_cols = _lag_block(series, spec, endog, maxlags, **window_kw)
    sample = lagged.dropna(subset=lag_cols)
    cols = [*lag_cols, *endog]

    def orders(row):
        n, _, scale, _, _, s, G = unpack(row, len(cols))
        C = centred(n, s, G)
        q = len(lag_cols)
        factor, sy, out = nested_factor(C, q)[q:], scale[q:], []
        for p in range(maxlags + 1):
            resid = C[q:, q:] - factor[:, :p * k] @ factor[:, :p * k].T
            sign, ld = np.linalg.slogdet(resid * np.outer(sy, sy) / n)
            if sign <= 0:
                out.append((row[spec.market], p, None, None, None, None))
                continue
            free, dfm = p * k * k + k, k * p + 1
            fpe = ((n + dfm) / (n - dfm)) ** k * math.exp(ld) if n > dfm else None
            out.append((row[spec.market], p, _f(ld + 2.0 / n * free), _f(ld + math.log(n) / n * free),
                        _f(ld + 2.0 * math.log(math.log(n)) / n * free), _f(fpe)))
        return out

    return _solve_rows(grouped_gram(sample, [spec.market], cols),
                       f"{_typed(df, spec)}, p int, aic double, bic double, hqic double, fpe double", orders)


# -- T5 ------------------------------------------------------------------------

VARX_EXOG = ("solar_forecast", "wind_forecast", "load_forecast")


def _required(df: DataFrame, cols) -> list[str]:
    """``cols`` as a list; a column that ``df`` lacks is an error, not a smaller model."""
    cols = list(cols or [])
    absent = [c for c in cols if c not in df.columns]
    if absent:
        raise KeyError(f"columns not found: {absent}")
    return cols


def fit_varx(df: DataFrame, spec: PanelSpec = PanelSpec(), endog=None, exog=VARX_EXOG, order: int = 24,
             **window_kw):
    """T5: conditional least squares VARX(order) with constant per market.

    Returns (coefficients: market, equation, regressor, coef;
             models: market, status, n_obs, aic, bic). A market whose fit fails
    (too few rows, singular design) gets status 'failed' and no coefficients.
    """
    endog = list(endog or [spec.target])
    exog = _required(df, exog)
    k = len(endog)
    series = df.where(F.col(spec.market).isNotNull()).dropna(subset=[*endog, *exog])
    lagged, lag_cols = _lag_block(series, spec, endog, order, **window_kw)
    sample = lagged.dropna(subset=lag_cols)
    regs = [*lag_cols, *exog]
    cols = [*regs, *endog]
    nr = len(regs)

    def solve(row):
        """One record for a market: status, counts, criteria and its coefficients."""
        m, n = row[spec.market], int(row["n"])
        if n <= nr + 1:
            return [(m, "failed", n, None, None, [])]
        st = unpack(row, len(cols))
        eqs = []
        for e in range(k):
            r = _ols_sub(st, list(range(nr)), nr + e)
            if r["rank"] < nr + 1:
                return [(m, "failed", n, None, None, [])]
            eqs.append((endog[e], "const", float(r["intercept"])))
            eqs += [(endog[e], regs[j], float(b)) for j, b in enumerate(r["beta"])]
        _, _, scale, _, _, s, G = st
        C = centred(n, s, G)
        factor = nested_factor(C, nr)[nr:]
        resid = C[nr:, nr:] - factor @ factor.T
        sign, ld = np.linalg.slogdet(resid * np.outer(scale[nr:], scale[nr:]) / n)
        n_params = k * (nr + 1) + k * (k + 1) // 2
        llf = -n / 2.0 * (k * math.log(2 * math.pi) + ld + k) if sign > 0 else float("nan")
        return [(m, "ok", n, _f(-2 * llf + 2 * n_params), _f(-2 * llf + math.log(n) * n_params), eqs)]

    solved = _solve_rows(grouped_gram(sample, [spec.market], cols),
                         f"{_typed(df, spec)}, status string, n_obs long, aic double, bic double, "
                         "coefs array<struct<equation:string,regressor:string,coef:double>>", solve)
    models = series.select(spec.market).distinct().join(solved.drop("coefs"), spec.market, "left").withColumn(
        "status", F.coalesce("status", F.lit("failed"))).fillna(0, "n_obs")
    return solved.select(spec.market, F.inline("coefs")), models


# -- T6 ------------------------------------------------------------------------

#: Horizon rows of a market that one task recurses over at a time.
FORECAST_BLOCK = 5_000


def forecast_varx(history: DataFrame, future: DataFrame, coefs: DataFrame, spec: PanelSpec = PanelSpec(),
                  endog=None, exog=VARX_EXOG, order: int = 24, steps: int | None = None) -> DataFrame:
    """Recursive multi-step forecast per market for a single endogenous series.

    ``history``: observed rows (the last ``order`` values seed the recursion);
    ``future``: the horizon rows with their exogenous values (first ``steps`` per
    market, in time order). Output: market, id, time, step, forecast (several endogenous series:
    forecast_{endog}...). A market without a model or without history has no rows; one with fewer
    than ``order`` observations gets NULL.

    At most ``FORECAST_BLOCK`` steps run as one fold per market; longer horizons, and all rows of
    ``future`` where ``steps`` is not given, run in blocks (``_forecast_blocks``): the same numbers
    up to rounding, and no market's horizon in one record.
    """
    endog = list(endog or [spec.target])
    exog = _required(future, exog)
    if steps is None or steps > FORECAST_BLOCK:
        return _forecast_blocks(history, future, coefs, spec, endog, exog, order, steps)
    if len(endog) != 1:
        return _forecast_multi(history, future, coefs, spec, endog, exog, order, steps)
    y = endog[0]
    # Coefficients to one row per market: const, exog coefficients, AR coefficient array (lag 1 first).
    c = coefs.where(F.col("equation") == y)
    ar_names = [f"{y}_lag_{p}h" for p in range(1, order + 1)]
    wide = c.groupBy(spec.market).agg(
        F.max(F.when(F.col("regressor") == "const", F.col("coef"))).alias("_const"),
        *[F.max(F.when(F.col("regressor") == e, F.col("coef"))).alias(f"_b_{e}") for e in exog],
        F.array(*[F.coalesce(F.max(F.when(F.col("regressor") == a, F.col("coef"))), F.lit(0.0))
                  for a in ar_names]).alias("_ar"))
    # Seed state: the last `order` observed values per market, oldest first.
    w_desc = Window.partitionBy(spec.market).orderBy(F.col(spec.time).desc(), F.col(spec.id).desc())
    tail = (history.where(F.col(spec.market).isNotNull() & F.col(y).isNotNull())
            .select(spec.market, spec.time, spec.id, y, F.row_number().over(w_desc).alias("_rk"))
            .where(F.col("_rk") <= order))
    seed = tail.groupBy(spec.market).agg(
        F.transform(F.sort_array(F.collect_list(F.struct(F.col("_rk"), F.col(y)))), lambda s: s[y])
        .alias("_newest_first"))
    seed = seed.select(spec.market, F.reverse("_newest_first").alias("_state"))
    # Horizon rows: exogenous part of the forecast per row, in parallel.
    w_asc = Window.partitionBy(spec.market).orderBy(F.col(spec.time).asc_nulls_last(), F.col(spec.id))
    fut = future.where(F.col(spec.market).isNotNull()).select(
        spec.market, spec.time, spec.id, *exog, F.row_number().over(w_asc).alias("step")).where(F.col("step") <= steps)
    fut = join_small(fut, wide, [spec.market])
    base = F.col("_const")
    for e in exog:
        base = base + F.coalesce(F.col(e), F.lit(0.0)) * F.coalesce(F.col(f"_b_{e}"), F.lit(0.0))
    horizon = fut.select(spec.market, "_ar", F.struct("step", spec.id, spec.time, base.alias("base")).alias("_h"))
    packed = horizon.groupBy(spec.market, "_ar").agg(F.sort_array(F.collect_list("_h")).alias("_hs"))
    packed = join_small(packed, seed, [spec.market])

    def ar_term(ar, state):
        return F.aggregate(F.zip_with(ar, F.reverse(state), lambda a, s: a * s), F.lit(0.0), lambda x, v: x + v)

    def step(acc, h):
        yhat = h["base"] + ar_term(F.col("_ar"), acc["st"])
        return F.struct(
            F.slice(F.concat(acc["st"], F.array(yhat)), 2, order).alias("st"),
            F.concat(acc["out"], F.array(F.struct(h["step"].alias("step"), h[spec.id].alias("id"),
                                                  h[spec.time].alias("time"), yhat.alias("forecast")))).alias("out"))

    init = F.struct(F.col("_state").alias("st"),
                    F.filter(F.array(F.lit(None).cast(
                        "struct<step:int,id:long,time:timestamp_ntz,forecast:double>")),
                        lambda x: F.lit(False)).alias("out"))
    folded = packed.select(spec.market, F.aggregate("_hs", init, step).alias("_acc"))
    return folded.select(spec.market, F.explode("_acc.out").alias("r")).select(
        spec.market, F.col("r.id").alias(spec.id), F.col("r.time").alias(spec.time),
        F.col("r.step").alias("step"), F.col("r.forecast").alias("forecast"))


def _forecast_multi(history: DataFrame, future: DataFrame, coefs: DataFrame, spec: PanelSpec, endog, exog,
                    order: int, steps: int) -> DataFrame:
    """T6 for several endogenous series: one group per market holding only its horizon rows
    (at most ``steps``) plus its model and last ``order`` observations; the recursion runs in
    numpy inside ``applyInPandas``. Output: market, id, time, step, forecast_{endog}..."""
    import pandas as pd
    from pyspark.sql import types as T

    k = len(endog)
    regs = ["const", *[f"{e}_lag_{p}h" for p in range(1, order + 1) for e in endog], *exog]
    # One row per market: the coefficient matrix flattened equation-major (k x len(regs)).
    cells = [F.max(F.when((F.col("equation") == e) & (F.col("regressor") == r), F.col("coef")))
             for e in endog for r in regs]
    model = coefs.groupBy(spec.market).agg(F.array(*[F.coalesce(c, F.lit(0.0)) for c in cells]).alias("_beta"))
    w_desc = Window.partitionBy(spec.market).orderBy(F.col(spec.time).desc(), F.col(spec.id).desc())
    tail = (history.where(F.col(spec.market).isNotNull()).dropna(subset=endog)
            .select(spec.market, *endog, F.row_number().over(w_desc).alias("_rk")).where(F.col("_rk") <= order))
    seed = tail.groupBy(spec.market).agg(
        F.sort_array(F.collect_list(F.struct("_rk", F.array(*[F.col(e) for e in endog]).alias("v")))).alias("_s"))
    seed = seed.select(spec.market, F.col("_s.v").alias("_seed"))  # newest first, each an array of k
    w_asc = Window.partitionBy(spec.market).orderBy(F.col(spec.time).asc_nulls_last(), F.col(spec.id))
    fut = future.where(F.col(spec.market).isNotNull()).select(
        spec.market, spec.id, spec.time, *exog, F.row_number().over(w_asc).alias("step")).where(F.col("step") <= steps)
    fut = join_small(join_small(fut, model, [spec.market]), seed, [spec.market])
    out_fields = [T.StructField(spec.market, T.StringType()), T.StructField(spec.id, T.LongType()),
                  T.StructField(spec.time, T.TimestampNTZType()), T.StructField("step", T.IntegerType())]
    out_fields += [T.StructField(f"forecast_{e}", T.DoubleType()) for e in endog]
    nr = len(regs)

    def run(pdf):
        pdf = pdf.sort_values("step")
        beta = np.asarray(pdf["_beta"].iloc[0], dtype=float).reshape(k, nr)
        state = [np.asarray(v, dtype=float) for v in pdf["_seed"].iloc[0]]  # newest first
        rows = []
        for _, r in pdf.iterrows():
            x = [1.0]
            for p in range(order):
                x.extend(state[p] if p < len(state) else np.full(k, np.nan))
            x.extend(0.0 if pd.isna(r[e]) else float(r[e]) for e in exog)
            yhat = beta @ np.asarray(x, dtype=float)
            state = [yhat] + state[:order - 1]
            rows.append([r[spec.market], int(r[spec.id]), r[spec.time], int(r["step"]), *map(float, yhat)])
        return pd.DataFrame(rows, columns=[f.name for f in out_fields])

    return fut.groupBy(spec.market).applyInPandas(run, T.StructType(out_fields))


def _recurse(ar: np.ndarray, state: np.ndarray, base: np.ndarray):
    """(forecasts, last state) of y_t = base_t + ar @ state; ``state`` holds the last values, newest first."""
    k = len(ar)
    out = np.empty_like(base)
    for t in range(len(base)):
        out[t] = base[t] + ar @ state
        state = np.concatenate([out[t], state[:-k]])
    return out, state


def _companion(ar: np.ndarray) -> np.ndarray:
    """The matrix that takes a state to the next one where ``base`` is zero."""
    k, width = ar.shape
    return np.vstack([ar, np.eye(width)[:width - k]])


def _forecast_blocks(history: DataFrame, future: DataFrame, coefs: DataFrame, spec: PanelSpec, endog, exog,
                     order: int, steps: int | None, block: int = FORECAST_BLOCK) -> DataFrame:
    """T6 for horizons of any length. The recursion is linear in its state, so a market's horizon is cut into blocks of
    ``block`` rows: every block recurses from a zero state at once; a market's chain of blocks, one short record each,
    then gives the state that each block starts from (companion matrix to the power of the block's length, plus the
    block's own end); every block recurses again from that. No task holds more than a block's rows, or one state per
    block of a market.
    """
    k, width = len(endog), len(endog) * order
    key = [spec.market, "_block"]
    market = future.schema[spec.market]

    def coef(e, r):
        return F.coalesce(F.max(F.when((F.col("equation") == e) & (F.col("regressor") == r), F.col("coef"))), F.lit(0.0))

    lags = [f"{e}_lag_{p}h" for p in range(1, order + 1) for e in endog]
    model = coefs.groupBy(spec.market).agg(
        F.array(*[coef(e, r) for e in endog for r in lags]).alias("_ar"),
        *[coef(e, r).alias(f"_b{i}_{j}") for i, e in enumerate(endog) for j, r in enumerate(["const", *exog])])
    newest = Window.partitionBy(spec.market).orderBy(F.col(spec.time).desc(), F.col(spec.id).desc())
    tail = (history.where(F.col(spec.market).isNotNull()).dropna(subset=endog)
            .select(spec.market, *endog, F.row_number().over(newest).alias("_rk")).where(F.col("_rk") <= order))
    seed = tail.groupBy(spec.market).agg(F.flatten(F.transform(
        F.sort_array(F.collect_list(F.struct("_rk", F.array(*[F.col(e).cast("double") for e in endog]).alias("v")))),
        lambda s: s["v"])).alias("_seed"))
    start = model.select(spec.market, "_ar").join(seed, spec.market)
    # Horizon rows with their number and the part of the forecast that needs no state.
    numbered = with_positions(future.where(F.col(spec.market).isNotNull()).select(spec.market, spec.id, spec.time, *exog),
                              [spec.market], [spec.time, spec.id])
    if steps is not None:
        numbered = numbered.where(F.col("_pos") < steps)
    base = [sum((F.coalesce(F.col(x).cast("double"), F.lit(0.0)) * F.col(f"_b{i}_{j}") for j, x in enumerate(exog, 1)),
                F.col(f"_b{i}_0")) for i in range(k)]
    rows = join_small(numbered, model.drop("_ar"), [spec.market]).select(
        spec.market, spec.id, spec.time, (F.col("_pos") + 1).cast("int").alias("step"),
        F.floor(F.col("_pos") / block).cast("long").alias("_block"), F.array(*base).alias("_base"))

    def ends(left, right):
        if left.empty or right.empty:
            return pd.DataFrame()
        left = left.sort_values("step")
        ar = np.array(right["_ar"].iloc[0], float).reshape(k, width)
        _, state = _recurse(ar, np.zeros(width), np.array(left["_base"].tolist(), float))
        return pd.DataFrame([[left[spec.market].iloc[0], left["_block"].iloc[0], len(left), state.tolist()]])

    def chain(left, right):
        if left.empty or right.empty:
            return pd.DataFrame()
        ar = np.array(right["_ar"].iloc[0], float).reshape(k, width)
        seeds = np.array(right["_seed"].iloc[0], float)
        state = np.concatenate([seeds, np.full(width - len(seeds), np.nan)])
        step, powers, out = _companion(ar), {}, []
        for _, b in left.sort_values("_block").iterrows():
            out.append([b[spec.market], b["_block"], ar.ravel().tolist(), state.tolist()])
            if b["_rows"] not in powers:
                powers[b["_rows"]] = np.linalg.matrix_power(step, b["_rows"])
            state = powers[b["_rows"]] @ state + np.array(b["_end"], float)
        return pd.DataFrame(out)

    def forecasts(left, right):
        if left.empty or right.empty:
            return pd.DataFrame()
        left = left.sort_values("step")
        ar = np.array(right["_ar"].iloc[0], float).reshape(k, width)
        y, _ = _recurse(ar, np.array(right["_state"].iloc[0], float), np.array(left["_base"].tolist(), float))
        out = left[[spec.market, spec.id, spec.time, "step"]].reset_index(drop=True)
        for e, name in enumerate(names):
            out[name] = y[:, e]
        return out

    arr, number = T.ArrayType(T.DoubleType()), T.StructField("_block", T.LongType())
    names = ["forecast"] if k == 1 else [f"forecast_{e}" for e in endog]
    fields = [market, future.schema[spec.id], future.schema[spec.time], T.StructField("step", T.IntegerType())]
    fields += [T.StructField(n, T.DoubleType()) for n in names]
    blocks = rows.select(*key).distinct().join(start.select(spec.market, "_ar"), spec.market).select(
        F.col(spec.market).alias("_m"), F.col("_block").alias("_b"), "_ar")  # names apart: both sides come from ``rows``
    ended = rows.groupBy(*key).cogroup(blocks.groupBy("_m", "_b")).applyInPandas(
        ends, T.StructType([market, number, T.StructField("_rows", T.LongType()), T.StructField("_end", arr)]))
    begun = ended.groupBy(spec.market).cogroup(start.groupBy(spec.market)).applyInPandas(
        chain, T.StructType([market, number, T.StructField("_ar", arr), T.StructField("_state", arr)]))
    return rows.groupBy(*key).cogroup(begun.groupBy(*key)).applyInPandas(forecasts, T.StructType(fields))
