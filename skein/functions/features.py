"""Row-level features (F1-F11) as column expressions, and the F9 composition.

All features of one step are emitted in ONE ``select`` (no withColumn chains);
window features of F9 share one window spec, so the composed plan has a single
exchange + sort for the ordered part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.operators.windows import window_features
from skein.spec import (INTERACTIONS, LAG_HOURS, MONTH_NAMES, PRIME_MORNING_HOURS,
                        PRIME_NIGHT_HOURS, ROLLING_WINDOWS, SQUARED_COLS, WEATHER_LAGS,
                        PanelSpec)


def _t(spec: PanelSpec) -> Column:
    return F.col(spec.time)


def weekday0(c: Column) -> Column:
    """Day of week with 0 = Monday (Spark ``weekday``; not ``dayofweek``)."""
    return F.weekday(c)


def _flag(cond: Column) -> Column:
    """0/1 int; a NULL input (missing time) counts as 0."""
    return F.coalesce(cond.cast("int"), F.lit(0))


# -- F1 -------------------------------------------------------------------------

def temporal_exprs(spec: PanelSpec = PanelSpec()) -> list[Column]:
    t = _t(spec)
    return [F.hour(t).alias("hour"), weekday0(t).alias("day_of_week"), F.month(t).alias("month"),
            _flag(weekday0(t) >= 5).alias("is_weekend")]


def add_temporal_features(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """hour, day_of_week (0 = Monday), month, is_weekend."""
    return df.select("*", *temporal_exprs(spec))


# -- F2 -------------------------------------------------------------------------

def add_time_dummies(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """hour_0..23, day_0..6, month_1..12 dummies (fixed sets, none dropped)."""
    t = _t(spec)
    exprs = [_flag(F.hour(t) == h).alias(f"hour_{h}") for h in range(24)]
    exprs += [_flag(weekday0(t) == d).alias(f"day_{d}") for d in range(7)]
    exprs += [_flag(F.month(t) == m).alias(f"month_{m}") for m in range(1, 13)]
    return df.select("*", *exprs)


# -- F3 / F4 / F5 ------------------------------------------------------------

def month_hour_names() -> list[str]:
    """All MONTH_{h}h names in category order (month-major)."""
    return [f"{m}_{h}h" for m in MONTH_NAMES for h in range(24)]


def add_month_hour_dummies(df: DataFrame, spec: PanelSpec = PanelSpec(),
                           drop_first: bool = True) -> DataFrame:
    """one dummy per (month, hour); the first category (JANUARY_0h) is dropped."""
    t = _t(spec)
    exprs = []
    for mi, m in enumerate(MONTH_NAMES, start=1):
        for h in range(24):
            if drop_first and mi == 1 and h == 0:
                continue
            exprs.append(_flag((F.month(t) == mi) & (F.hour(t) == h)).alias(f"{m}_{h}h"))
    return df.select("*", *exprs)


def add_time_prime_dummies(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """month dummies (January dropped) + {MONTH}_PrimeMorning / _PrimeNight for all 12."""
    t = _t(spec)
    exprs = [_flag(F.month(t) == mi).alias(m) for mi, m in enumerate(MONTH_NAMES, start=1) if mi > 1]
    for mi, m in enumerate(MONTH_NAMES, start=1):
        exprs.append(_flag((F.month(t) == mi) & F.hour(t).isin(PRIME_MORNING_HOURS))
                     .alias(f"{m}_PrimeMorning"))
        exprs.append(_flag((F.month(t) == mi) & F.hour(t).isin(PRIME_NIGHT_HOURS))
                     .alias(f"{m}_PrimeNight"))
    return df.select("*", *exprs)


def add_weekend_dummy(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """isWeekend (Saturday/Sunday) as 0/1; a missing time gives 0."""
    return df.select("*", _flag(weekday0(_t(spec)).isin(5, 6)).alias("isWeekend"))


# -- F6 / F7 / F8 ------------------------------------------------------------

def add_squared_features(df: DataFrame, cols=None, missing: str = "error") -> DataFrame:
    """``{c}_sq`` = c * c. ``missing='error'`` (F6) or ``'skip'``."""
    cols = list(SQUARED_COLS if cols is None else cols)
    have = set(df.columns)
    if missing == "error":
        absent = [c for c in cols if c not in have]
        if absent:
            raise KeyError(f"columns not found: {absent}")
    return df.select("*", *[(F.col(c) * F.col(c)).alias(f"{c}_sq") for c in cols if c in have])


def add_interaction_features(df: DataFrame, pairs=None) -> DataFrame:
    """F8: ``{a}_x_{b}`` = a * b for each pair."""
    pairs = list(INTERACTIONS if pairs is None else pairs)
    return df.select("*", *[(F.col(a) * F.col(b)).alias(f"{a}_x_{b}") for a, b in pairs])


# -- F10 / F11 ---------------------------------------------------------------

def clip(c: Column, lo: float, hi: float) -> Column:
    """clip to [lo, hi]; NULL stays NULL."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def add_clipped(df: DataFrame, col: str, lo: float = -100.0, hi: float = 200.0,
                name: str | None = None) -> DataFrame:
    return df.select("*", clip(F.col(col), lo, hi).alias(name or f"{col}_clipped"))


# -- F9 -----------------------------------------------------------------------

def engineer_features(df: DataFrame, spec: PanelSpec = PanelSpec(), include_lags: bool = True,
                      include_rolling: bool = True, lags=None, windows=None,
                      weather_cols=None, squared=None, interactions=None, **window_kw) -> DataFrame:
    """temporal -> squared -> interactions -> weather lags -> (target lags) -> (rolling).

    Target steps run only when the frame has a target column. All ordered features
    are computed in one window pass.
    """
    out = add_temporal_features(df, spec)
    out = add_squared_features(out, squared)
    out = add_interaction_features(out, interactions)
    lag_list = list(LAG_HOURS if lags is None else lags)
    wcols = [c for c in (WEATHER_LAGS if weather_cols is None else weather_cols) if c in out.columns]
    lag_cfg = {c: lag_list for c in wcols}
    roll_cfg = {}
    if spec.target in out.columns:
        if include_lags:
            lag_cfg[spec.target] = lag_list
        if include_rolling:
            roll_cfg[spec.target] = list(ROLLING_WINDOWS if windows is None else windows)
    return window_features(out, spec, lags=lag_cfg, rolling=roll_cfg, **window_kw)
