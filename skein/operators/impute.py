"""Imputation (I1, I2) and null reporting (I4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.operators.sizing import join_small
from skein.operators.stats import group_quantiles
from skein.operators.windows import fill_forward_backward
from skein.spec import PanelSpec


def impute_median(df: DataFrame, spec: PanelSpec = PanelSpec(), cols=None,
                  exact: bool = True) -> DataFrame:
    """Fill nulls with the market's median (linear interpolation, nulls ignored).

    The medians form a small (market x column) table, joined back once.
    """
    cols = [c for c in (cols or spec.features) if c in df.columns]
    med = group_quantiles(df, [spec.market], cols, [0.5], exact=exact)
    wide = (med.groupBy(spec.market).pivot("column_name", cols)
            .agg(F.first("value")))
    wide = wide.select(spec.market, *[F.col(c).alias(f"_med_{c}") for c in cols])
    joined = join_small(df, wide, [spec.market], how="left")
    wanted = set(cols)
    out = []
    for c in df.columns:
        if c in wanted:
            out.append(F.when(F.col(spec.market).isNotNull(),
                              F.coalesce(F.col(c), F.col(f"_med_{c}"))).alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out)


def impute_missing(df: DataFrame, spec: PanelSpec = PanelSpec(), method: str = "ffill",
                   cols=None, **kw) -> DataFrame:
    """I1/I2 dispatch: ``ffill`` (forward then backward fill per market) or ``median``.

    Extra keywords go to the operator (e.g. the window ``strategy`` of ffill); ``strategy`` may also name the method.
    """
    if kw.get("strategy") in ("ffill", "median"):
        method = kw.pop("strategy")
    if method == "ffill":
        return fill_forward_backward(df, spec, cols, **kw)
    if method == "median":
        return impute_median(df, spec, cols, **kw)
    raise ValueError(f"Unknown imputation strategy: {method}")


def null_counts(df: DataFrame, cols=None, only_positive: bool = False) -> DataFrame:
    """I4: (column, n_null) for each column, from one aggregate."""
    cols = list(cols or df.columns)
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = one.unpivot([], cols, "column_name", "n_null")
    return long.where(F.col("n_null") > 0) if only_positive else long
