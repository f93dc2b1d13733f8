"""Market encoding (E1, E2) and standard scaling.

Categories and scaler statistics are fitted once (on train) and applied to any
frame, so train and test always get the same columns (unlike per-frame dummies).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import NumericType

from skein.operators.positions import with_positions
from skein.operators.sizing import bounded_collect, join_small

MAX_INLINE_CATEGORIES = 10_000


def fit_categories(df: DataFrame, col: str, max_categories: int = MAX_INLINE_CATEGORIES) -> list:
    """Sorted distinct non-null values of ``col`` (a small set, size checked)."""
    rows = bounded_collect(df.where(F.col(col).isNotNull()).select(col).distinct(), max_categories)
    if rows is None:
        raise ValueError(f"{col} has more than {max_categories} categories, one column each; label_encode takes any number")
    return sorted(r[0] for r in rows)


def one_hot(df: DataFrame, col: str, categories=None, prefix: str | None = None) -> DataFrame:
    """``{prefix}_{value}`` 0/1 int columns in sorted category order; NULL -> all 0.

    The original column is kept. ``categories`` default: fitted on ``df`` itself.
    """
    cats = list(categories) if categories is not None else fit_categories(df, col)
    prefix = prefix or col
    c = F.col(col)
    return df.select("*", *[F.coalesce((c == F.lit(v)).cast("int"), F.lit(0)).alias(f"{prefix}_{v}")
                            for v in cats])


def category_ranks(df: DataFrame, col: str, name: str) -> DataFrame:
    """(``col``, ``name``): the distinct non-null values of ``col`` with their ranks in sorted order, from 0. Ranked by
    range partitions, so the number of values has no limit."""
    values = df.where(F.col(col).isNotNull()).select(col).distinct()
    return with_positions(values, [], [col], "_rank").select(col, F.col("_rank").cast("int").alias(name))


def label_encode(df: DataFrame, col: str, categories=None, name: str | None = None) -> DataFrame:
    """Rank of the value in sorted categories, from 0; unseen or NULL -> NULL.

    ``categories``: a list, or a table as ``category_ranks`` makes it (``col``, ``name``), e.g. fitted on train; default:
    the values of ``df`` itself, however many.
    """
    name = name or f"{col}_label"
    if categories is None:
        categories = category_ranks(df, col, name)
    if isinstance(categories, DataFrame):
        table = categories.select(F.col(col), F.col(name))
    else:
        cats = list(categories)
        if len(cats) <= MAX_INLINE_CATEGORIES:
            pos = F.array_position(F.array(*[F.lit(v) for v in cats]), F.col(col))
            return df.select("*", F.when(pos > 0, pos - 1).cast("int").alias(name))
        kind = T.StructType([T.StructField(col, df.schema[col].dataType), T.StructField(name, T.IntegerType())])
        table = df.sparkSession.createDataFrame([(v, i) for i, v in enumerate(cats)], kind)
    return join_small(df, table, [col], how="left").select(*df.columns, name)


def encode_market(df: DataFrame, col: str = "market", method: str = "onehot", categories=None) -> DataFrame:
    """E1/E2 dispatch."""
    if method == "onehot":
        return one_hot(df, col, categories)
    if method == "label":
        return label_encode(df, col, categories)
    raise ValueError(f"Unknown encoding method: {method}")


def fit_scaler(df: DataFrame, cols) -> DataFrame:
    """E4 fit: (column, mean, scale) with population std; zero or undefined std -> scale 1."""
    cols = list(cols)
    row = df.agg(*[F.avg(F.col(c)).alias(f"m{i}") for i, c in enumerate(cols)],
                 *[F.stddev_pop(F.col(c)).alias(f"s{i}") for i, c in enumerate(cols)])
    long = row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std"))
        for i, c in enumerate(cols)])).alias("s")).select("s.*")
    return long.select("column", "mean", "std",
                       F.when((F.col("std").isNull()) | (F.col("std") == 0), F.lit(1.0))
                       .otherwise(F.col("std")).alias("scale"))


def apply_scaler(df: DataFrame, scaler: DataFrame | list, cols=None) -> DataFrame:
    """E4 transform: (c - mean) / scale for each fitted column present in ``df``.

    The scaler is a k-row table (k = number of columns), read once on the driver.
    """
    rows = scaler.collect() if isinstance(scaler, DataFrame) else scaler
    stats = {r["column"]: (r["mean"], r["scale"]) for r in rows}
    cols = set(cols or stats)
    out = []
    for c in df.columns:
        if c in cols and c in stats:
            mu, sc = stats[c]
            out.append(((F.col(c) - F.lit(mu if mu is not None else 0.0)) / F.lit(sc)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def scale_features(train: DataFrame, val: DataFrame | None = None, test: DataFrame | None = None,
                   cols=None):
    """Fit on train, transform train / val / test. Returns (scaler, train, val, test).

    Without ``cols`` every numeric column of ``train`` is scaled, except ids and the target.
    """
    if cols is None:
        cols = [f.name for f in train.schema.fields
                if isinstance(f.dataType, NumericType) and f.name not in ("id", "target")]
    scaler = fit_scaler(train, cols)
    rows = scaler.collect()
    t = apply_scaler(train, rows, cols)
    v = apply_scaler(val, rows, cols) if val is not None else None
    s = apply_scaler(test, rows, cols) if test is not None else None
    return scaler, t, v, s
