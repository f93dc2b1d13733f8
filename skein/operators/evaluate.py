"""Metrics (M1-M6): MAE, RMSE, MAPE, R2 in one aggregate, overall or per market."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAPE_EPSILON = 1e-8


def metric_exprs(y: str, p: str, epsilon: float = MAPE_EPSILON) -> list[Column]:
    """M1-M4 as aggregate expressions over one pass, on the rows that have both y and p.

    R2 = 1 - SSE / SST with SST = n * var_pop(y); constant y gives 1 when SSE = 0 else 0;
    fewer than two rows gives NULL.
    """
    e = F.col(y) - F.col(p)
    actual = F.when(e.isNotNull(), F.col(y))
    n = F.count(e)
    sse = F.sum(e * e)
    sst = F.var_pop(actual) * n
    r2 = (F.when(n < 2, F.lit(None).cast("double"))
          .when(sst == 0, F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
          .otherwise(1 - sse / sst))
    return [
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.avg(F.abs(e) / (F.abs(F.col(y)) + F.lit(epsilon))) * 100).alias("mape"),
        r2.alias("r2"),
        n.alias("n_rows"),
    ]


def null_inputs(y: str, p: str) -> Column:
    return F.count_if(F.col(y).isNull() | F.col(p).isNull()).alias("n_null")


def metrics(df: DataFrame, y: str = "target", p: str = "pred") -> DataFrame:
    """M5: all four metrics in one pass over the rows that have y and p; ``n_null`` counts the others."""
    return df.agg(*metric_exprs(y, p), null_inputs(y, p))


def metrics_by_market(df: DataFrame, y: str = "target", p: str = "pred",
                      market: str = "market") -> DataFrame:
    """M6: metrics and ``n_null`` per market (one grouped aggregate, not a loop), sorted by market.

    A market without a single complete row stays, with NULL metrics; rows without a market are a group of their own.
    """
    return df.groupBy(market).agg(*metric_exprs(y, p), null_inputs(y, p)).orderBy(market)


def evaluate(df: DataFrame, y: str = "target", p: str = "pred") -> dict:
    """M5 as a dict; raises when y or p has NULLs (the metric library would raise too)."""
    row = df.agg(null_inputs(y, p), *metric_exprs(y, p)).first().asDict()
    if row["n_null"]:
        raise ValueError(f"{row['n_null']} rows with NULL {y} or {p}")
    return {"MAE": row["mae"], "RMSE": row["rmse"], "MAPE": row["mape"], "R2": row["r2"],
            "n_rows": row["n_rows"]}


def mae(df: DataFrame, y: str = "target", p: str = "pred") -> DataFrame:
    """M1."""
    return df.agg(F.avg(F.abs(F.col(y) - F.col(p))).alias("mae"))


def rmse(df: DataFrame, y: str = "target", p: str = "pred") -> DataFrame:
    """M2."""
    e = F.col(y) - F.col(p)
    return df.agg(F.sqrt(F.avg(e * e)).alias("rmse"))


def mape(df: DataFrame, y: str = "target", p: str = "pred", epsilon: float = MAPE_EPSILON) -> DataFrame:
    """M3."""
    e = F.abs(F.col(y) - F.col(p))
    return df.agg((F.avg(e / (F.abs(F.col(y)) + F.lit(epsilon))) * 100).alias("mape"))


def r2(df: DataFrame, y: str = "target", p: str = "pred") -> DataFrame:
    """M4."""
    return df.agg(metric_exprs(y, p)[3])
