"""Aggregations and descriptive statistics (A1-A10) plus exact grouped quantiles.

Exact quantiles neither sort nor gather a group: counting passes narrow down the needed
ranks (``quantiles.exact_quantiles``). ``exact=False`` uses ``percentile_approx``.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.operators.quantiles import exact_quantiles
from skein.operators.sizing import bounded_collect, join_small
from skein.spec import PanelSpec


def melt(df: DataFrame, cols, id_cols=(), name: str = "column_name", value: str = "value",
         drop_nulls: bool = True) -> DataFrame:
    """Wide numeric columns to a long (id..., column, value) table with double values."""
    cast = df.select(*id_cols, *[F.col(c).cast("double").alias(c) for c in cols])
    long = cast.unpivot(list(id_cols), list(cols), name, value)
    return long.where(F.col(value).isNotNull()) if drop_nulls else long


def group_quantiles(df: DataFrame, group_cols, cols, probs, exact: bool = True,
                    accuracy: int = 100_000) -> DataFrame:
    """(group..., column, prob, value): linear-interpolated quantiles, nulls ignored."""
    group_cols = list(group_cols)
    probs = [float(p) for p in probs]
    if not exact:
        long = melt(df, cols, group_cols)
        q = long.groupBy(*group_cols, "column_name").agg(
            F.percentile_approx("value", probs, accuracy).alias("_qs"))
        return q.select(*group_cols, "column_name",
                        F.posexplode("_qs").alias("_i", "value")).select(
            *group_cols, "column_name", F.get(F.array(*[F.lit(p) for p in probs]), F.col("_i")).alias("prob"), "value")
    return exact_quantiles(df, group_cols, cols, probs)


def _quartile_cols(names):
    return [F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n)
            for p, n in zip([0.25, 0.5, 0.75], names)]


# -- A1-A3 --------------------------------------------------------------------

def summary(df: DataFrame, col: str, ddof: int = 1) -> DataFrame:
    """A1: mean / std / min / max of one column (``ddof`` 1 = sample, 0 = population)."""
    std = F.stddev_samp(col) if ddof == 1 else F.stddev_pop(col)
    return df.agg(F.avg(col).alias("mean"), std.alias("std"), F.min(col).alias("min"),
                  F.max(col).alias("max"))


def count_range_by_market(df: DataFrame, spec: PanelSpec = PanelSpec(), col: str | None = None) -> DataFrame:
    """A2: rows and value range per market."""
    col = col or spec.target
    return (df.where(F.col(spec.market).isNotNull()).groupBy(spec.market)
            .agg(F.count(F.lit(1)).alias("n_rows"), F.min(col).alias("min"), F.max(col).alias("max")))


def time_span(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """A3: first and last time."""
    return df.agg(F.min(spec.time).alias("first_time"), F.max(spec.time).alias("last_time"))


# -- A4 -----------------------------------------------------------------------

def describe(df: DataFrame, cols, exact: bool = True) -> DataFrame:
    """A4: transposed describe: count, mean, std (ddof 1), min, 25/50/75 %, max per column."""
    wide = df.select(*cols).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        moments = melt(wide, cols).groupBy("column_name").agg(
            F.count(F.lit(1)).alias("count"), F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
            F.max("value").alias("max"))
        moments = df.sparkSession.createDataFrame(moments.collect(), moments.schema)  # a row for each column
        q = group_quantiles(wide, [], cols, [0.25, 0.5, 0.75], exact=exact)
    finally:
        wide.unpersist()
    qw = q.groupBy("column_name").agg(*_quartile_cols(["p25", "p50", "p75"]))
    return moments.join(qw, "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


#: Columns that a pivot may have.
MAX_PIVOT_COLUMNS = 10_000


# -- A5 -----------------------------------------------------------------------

def mean_profile(df: DataFrame, spec: PanelSpec = PanelSpec(), by: str = "hour", col: str | None = None) -> DataFrame:
    """A5 as rows: (market, ``by``, mean, n) for every market and hour (or month) with a value; any number of markets."""
    col = col or spec.target
    key = {"hour": F.hour, "month": F.month}[by](F.col(spec.time)).alias(by)
    return df.where(F.col(spec.market).isNotNull() & F.col(col).isNotNull()).groupBy(spec.market, key).agg(
        F.avg(col).alias("mean"), F.count(F.lit(1)).alias("n"))


def mean_pivot(df: DataFrame, spec: PanelSpec = PanelSpec(), by: str = "hour",
               col: str | None = None, markets=None) -> DataFrame:
    """A5: mean of ``col`` by hour (or month) with one column per market; ``mean_profile`` has the same means as rows.

    Without ``markets`` they are read from the data; more of them than ``MAX_PIVOT_COLUMNS`` make no table that a reader
    or Spark's planner could use, and raise.
    """
    col = col or spec.target
    key = {"hour": F.hour, "month": F.month}[by](F.col(spec.time)).alias(by)
    base = df.where(F.col(spec.market).isNotNull() & F.col(col).isNotNull())
    if markets is None:
        rows = bounded_collect(base.select(spec.market).distinct(), MAX_PIVOT_COLUMNS)
        if rows is None:
            raise ValueError(f"more than {MAX_PIVOT_COLUMNS} markets, one column each; mean_profile takes any number")
        markets = sorted(r[0] for r in rows)
    return base.groupBy(key).pivot(spec.market, list(markets)).agg(F.avg(col))


# -- A6 -----------------------------------------------------------------------

def histogram(df: DataFrame, col: str, bins: int = 100) -> DataFrame:
    """``bins`` equal-width bins from min to max, the last bin closed.

    (bin, lo, hi, count) for every bin, empty ones included. A constant column
    spans [v - 0.5, v + 0.5] as numpy does.
    """
    base = df.where(F.col(col).isNotNull())
    lo, hi = base.agg(F.min(col), F.max(col)).first()
    spark = df.sparkSession
    if lo is None:
        return spark.createDataFrame([], "bin long, lo double, hi double, count long")
    lo, hi = float(lo), float(hi)
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = hi - lo
    b = F.least(F.floor((F.col(col) - F.lit(lo)) * F.lit(float(bins)) / F.lit(width)),
                F.lit(bins - 1)).cast("long")
    counts = base.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    edges = spark.range(bins).select(
        F.col("id").alias("bin"),
        (F.lit(lo) + F.col("id") * F.lit(width) / F.lit(float(bins))).alias("lo"),
        (F.lit(lo) + (F.col("id") + 1) * F.lit(width) / F.lit(float(bins))).alias("hi"))
    return edges.join(counts, "bin", "left").select(
        "bin", "lo", "hi", F.coalesce("count", F.lit(0)).alias("count"))


# -- A7 / A8 ------------------------------------------------------------------

def box_stats(df: DataFrame, spec: PanelSpec = PanelSpec(), col: str | None = None,
              whis: float = 1.5, exact: bool = True) -> DataFrame:
    """Quartiles and whiskers (furthest point within ``whis`` x IQR) per market."""
    col = col or spec.target
    base = df.where(F.col(spec.market).isNotNull())
    q = group_quantiles(base, [spec.market], [col], [0.25, 0.5, 0.75], exact=exact)
    qw = q.groupBy(spec.market).agg(*_quartile_cols(["q1", "median", "q3"]))
    fences = qw.select(spec.market, "q1", "median", "q3",
                       (F.col("q1") - whis * (F.col("q3") - F.col("q1"))).alias("_lf"),
                       (F.col("q3") + whis * (F.col("q3") - F.col("q1"))).alias("_hf"))
    j = join_small(base.select(spec.market, col), fences, [spec.market])
    x = F.col(col)
    return j.groupBy(spec.market, "q1", "median", "q3").agg(
        F.min(F.when(x >= F.col("_lf"), x)).alias("whisker_lo"),
        F.max(F.when(x <= F.col("_hf"), x)).alias("whisker_hi"))


def median(df: DataFrame, col: str, exact: bool = True) -> DataFrame:
    """Median of one column."""
    q = group_quantiles(df, [], [col], [0.5], exact=exact)
    return q.select(F.col("value").alias("median"))


# -- A9 -----------------------------------------------------------------------

def corr_long(df: DataFrame, cols) -> DataFrame:
    """Pearson correlation of every ordered pair (f1, f2), pairwise-complete rows, in one masked Gram pass.

    NULL when either column is constant (or absent) on the shared rows; 1 on the diagonal of any other column.
    """
    from skein.operators.gram import masked_corr
    return masked_corr(df, list(cols))


# -- A10 ----------------------------------------------------------------------

def daily_series(df: DataFrame, spec: PanelSpec = PanelSpec(), col: str | None = None,
                 unit: str = "day") -> DataFrame:
    """A10: down-sampled series per market for plotting: mean/min/max/count per ``unit``."""
    col = col or spec.target
    t = F.date_trunc(unit, F.col(spec.time)).cast("timestamp_ntz").alias("period")
    return (df.where(F.col(spec.market).isNotNull() & F.col(col).isNotNull())
            .groupBy(spec.market, t)
            .agg(F.avg(col).alias("mean"), F.min(col).alias("min"), F.max(col).alias("max"),
                 F.count(F.lit(1)).alias("n_rows")))
