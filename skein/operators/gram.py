"""Grouped sufficient statistics (moments and Gram matrices) in one distributed pass.

Every task sums, per group it sees, the count, its own mean, the cross-products about that mean, minima and maxima
(numpy over Arrow batches in ``mapInPandas``) and emits one partial row per (partition, group), sooner when the blocks
it holds reach ``FLUSH_BYTES``. The partials, a small table, are written once to the checkpoint folder, so the rows are
read once however often the merge reads its input. Spark merges them exactly with the parallel-variance rule and
returns one row per group:

    group..., n, mean[k], scale[k], min[k], max[k], s[k] (sum of z), g[k*k] (sum of z zᵀ)

A hot group is spread over every task that holds its rows; nothing ever gathers a group's rows. Uncentred sums and sums
about a fixed (shift, scale) follow from the centred ones: C + n d dᵀ with d = mean - shift.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.session import ensure_checkpoint_dir, wide_plan_guard

#: Bytes of per-group blocks a task holds before it emits them.
FLUSH_BYTES = 64 << 20


# -- the data pass -----------------------------------------------------------------

def _own_mean_kernel(group_cols, cols, flush_bytes):
    """Per (partition, group): n, own mean, cross-products about the own mean, min, max."""
    k = len(cols)
    most = max(1, flush_bytes // (8 * (k * k + 4 * k)))

    def partials(acc):
        rows = []
        for key, (n, x0, s1, s2, lo, hi) in acc.items():
            m = s1 / n
            rows.append({**dict(zip(group_cols, key)), "_n": int(n), "_m": (x0 + m).tolist(),
                         "_c": (s2 - n * np.outer(m, m)).ravel().tolist(), "_lo": lo.tolist(), "_hi": hi.tolist()})
        return pd.DataFrame(rows, columns=[*group_cols, "_n", "_m", "_c", "_lo", "_hi"])

    def run(it):
        acc = {}
        for pdf in it:
            if pdf.empty:
                continue
            X = pdf[cols].to_numpy(dtype=np.float64)
            for key, idx in pdf.groupby(group_cols, sort=False, dropna=False).indices.items():
                key = key if isinstance(key, tuple) else (key,)
                Z = X[idx]
                a = acc.get(key)
                if a is None:
                    if len(acc) >= most:
                        yield partials(acc)
                        acc.clear()
                    # shift by the first row seen: sums stay small
                    a = acc[key] = [0, Z[0].copy(), np.zeros(k), np.zeros((k, k)), Z.min(0), Z.max(0)]
                D = Z - a[1]
                a[0] += len(idx)
                a[2] += D.sum(axis=0)
                a[3] += D.T @ D
                a[4] = np.minimum(a[4], Z.min(0))
                a[5] = np.maximum(a[5], Z.max(0))
        if acc:
            yield partials(acc)

    return run


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table below the checkpoint folder: later reads do not run its plan again."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/gram-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def grouped_gram(df: DataFrame, group_cols, cols, center: bool = True, fixed=None) -> DataFrame:
    """One row per group with n, moments and the sums of z and z zᵀ of the standardised columns.

    Rows must already be complete in ``cols`` (use ``dropna(subset=cols)``); rows without a group key are left out.
    ``center=False`` only scales, by the root mean square (uncentred Gram, e.g. for VIF); ``mean`` is then 0.
    ``fixed=(shift, scale)`` standardises every group with the same vectors (e.g. folds of one data set).
    A constant column has scale 1 when centred.
    """
    cols = list(cols)
    user_groups = list(group_cols)
    # An ungrouped pass uses a constant key so every join below stays an equi-join.
    group_cols = user_groups or ["_all"]
    k = len(cols)
    wide_plan_guard(df.sparkSession)
    src = df if user_groups else df.withColumn("_all", F.lit(0))
    base = src.select(*group_cols, *[F.col(c).cast("double").alias(c) for c in cols]).dropna(subset=group_cols)
    arr = T.ArrayType(T.DoubleType())
    schema = T.StructType([f for f in base.schema.fields if f.name in group_cols] + [
        T.StructField("_n", T.LongType()), T.StructField("_m", arr), T.StructField("_c", arr),
        T.StructField("_lo", arr), T.StructField("_hi", arr)])
    parts = written(base.mapInPandas(_own_mean_kernel(group_cols, cols, FLUSH_BYTES), schema))
    idx = F.sequence(F.lit(0), F.lit(k - 1))
    # Group totals: n, mean (n-weighted), min, max.
    tot = parts.groupBy(*group_cols).agg(
        F.sum("_n").alias("_N"),
        *[F.sum(F.col("_n") * F.col("_m")[i]).alias(f"_sm{i}") for i in range(k)],
        *[F.min(F.col("_lo")[i]).alias(f"_mn{i}") for i in range(k)],
        *[F.max(F.col("_hi")[i]).alias(f"_mx{i}") for i in range(k)])
    tot = tot.select(*group_cols, "_N",
                     F.array(*[F.col(f"_sm{i}") / F.col("_N") for i in range(k)]).alias("mean"),
                     F.array(*[F.col(f"_mn{i}") for i in range(k)]).alias("min"),
                     F.array(*[F.col(f"_mx{i}") for i in range(k)]).alias("max"))
    # Each partial's cells: own M2 plus n_p d dᵀ, summed cell by cell per group.
    j = parts.join(tot.select(*group_cols, "mean"), group_cols, "inner")
    d = F.zip_with("_m", "mean", lambda a, b: a - b)
    cells = j.select(*group_cols, F.zip_with(
        "_c", F.flatten(F.transform(d, lambda a: F.transform(d, lambda b: a * b))),
        lambda c, o: c + o * F.col("_n").cast("double")).alias("_cell"))
    summed = cells.select(*group_cols, F.posexplode("_cell").alias("_i", "_v")).groupBy(*group_cols, "_i").agg(
        F.sum("_v").alias("_v"))
    packed = summed.groupBy(*group_cols).agg(F.sort_array(F.collect_list(F.struct("_i", "_v"))).alias("_s"))
    out = packed.join(tot, group_cols, "inner")
    C = F.col("_s._v")
    sd = F.transform(idx, lambda i: F.when((C[i * k + i] > 0) & (F.col("min")[i] < F.col("max")[i]),
                                           F.sqrt(C[i * k + i] / F.col("_N"))).otherwise(F.lit(1.0)))
    if fixed is not None:
        shift, scale = (F.array(*[F.lit(float(v)) for v in vec]) for vec in fixed)
    elif center:
        shift, scale = F.col("mean"), sd
    else:
        shift = F.array_repeat(F.lit(0.0), k)
        scale = F.zip_with("mean", sd, lambda m, s_: F.sqrt(m * m + s_ * s_))
    out = out.select(*user_groups, F.col("_N").alias("n"), shift.alias("_shift"), scale.alias("scale"), "min", "max",
                     F.zip_with("mean", shift, lambda m, s_: m - s_).alias("_d"), C.alias("_C"))
    i, n = lambda t: F.floor(t / k).cast("int"), F.col("n")
    return out.select(*user_groups, "n", F.col("_shift").alias("mean"), "scale", "min", "max",
                      F.zip_with("_d", "scale", lambda d, s_: n * d / s_).alias("s"),
                      F.transform(F.sequence(F.lit(0), F.lit(k * k - 1)), lambda t: (
                          F.col("_C")[t] + n * F.col("_d")[i(t)] * F.col("_d")[(t % k).cast("int")]
                      ) / (F.col("scale")[i(t)] * F.col("scale")[(t % k).cast("int")])).alias("g"))


def classed_gram(df: DataFrame, group_cols, indicators, numeric) -> DataFrame:
    """``grouped_gram`` of (indicators..., numeric...) from sums per class: rows of a group that agree in every 0/1 column of
    ``indicators`` form a class. The data pass sums the ``numeric`` columns of each class only; the products of indicators
    with each other and with numeric columns follow from the classes' counts and means, one row a class.

    For indicators of a fixed calendar (month, hour class, weekend), whose combinations are few whatever the number of
    rows: a group's classes are put together in one record. Values that are not 0 or 1 raise.
    """
    group_cols, indicators, numeric = list(group_cols), list(indicators), list(numeric)
    by_name = {f.name: f for f in df.schema.fields}
    q, k = len(indicators), len(indicators) + len(numeric)
    flags = [F.when(F.col(c) == 1, F.lit("1")).when(F.col(c) == 0, F.lit("0"))
             .when(F.col(c).isNotNull(), F.raise_error(F.lit(f"{c} holds values other than 0 and 1"))) for c in indicators]
    classes = df.dropna(subset=[*group_cols, *indicators, *numeric]).select(
        *group_cols, F.concat(*flags).alias("_class"), *numeric)
    cells = grouped_gram(classes, [*group_cols, "_class"], numeric)
    packed = cells.groupBy(*group_cols).agg(
        F.collect_list(F.struct("_class", "n", "mean", "scale", "min", "max", "s", "g")).alias("_cells"))
    arr = T.ArrayType(T.DoubleType())
    schema = T.StructType([T.StructField(c, by_name[c].dataType) for c in group_cols] + [
        T.StructField("n", T.LongType())] + [T.StructField(c, arr) for c in ("mean", "scale", "min", "max", "s", "g")])

    def run(it):
        for pdf in it:
            out = []
            for _, row in pdf.iterrows():
                cells = sorted(row["_cells"], key=lambda c: c["_class"])
                out.append([*(row[c] for c in group_cols), *_merged_classes(cells, q, len(numeric))])
            yield pd.DataFrame(out, columns=[f.name for f in schema.fields])

    return packed.mapInPandas(run, schema)


def _merged_classes(cells, q: int, k: int):
    """n, mean, scale, min, max, s, g of (q indicators, k numeric columns) from a group's classes."""
    stats = [unpack(c, k) for c in cells]
    n = np.array([st[0] for st in stats], float)
    # A row a class: its indicators, then its numeric means.
    rows = np.array([[*map(float, c["_class"]), *(st[1] + st[2] * st[5] / st[0])] for c, st in zip(cells, stats)])
    total = n.sum()
    mean = n @ rows / total
    away = rows - mean
    C = (away * n[:, None]).T @ away
    for st in stats:
        C[q:, q:] += centred(st[0], st[5], st[6]) * np.outer(st[2], st[2])
    flags = rows[:, :q]
    lo = np.concatenate([flags.min(0), np.min([st[3] for st in stats], axis=0)])
    hi = np.concatenate([flags.max(0), np.max([st[4] for st in stats], axis=0)])
    varies = (np.diag(C) > 0) & (lo < hi)
    scale = np.where(varies, np.sqrt(np.where(varies, np.diag(C), 1.0) / total), 1.0)
    return [int(total), mean.tolist(), scale.tolist(), lo.tolist(), hi.tolist(), [0.0] * len(mean),
            (C / np.outer(scale, scale)).ravel().tolist()]


def unpack(row, k: int):
    """(n, mean, scale, min, max, s, G) numpy views of one Gram row."""
    return (int(row["n"]), np.array(row["mean"], float), np.array(row["scale"], float),
            np.array(row["min"], float), np.array(row["max"], float),
            np.array(row["s"], float), np.array(row["g"], float).reshape(k, k))


def centred(n: int, s: np.ndarray, g: np.ndarray) -> np.ndarray:
    """Cross-products about the sample mean: G - s sᵀ / n (s is ~0 after centring)."""
    return g - np.outer(s, s) / n


# -- pairwise-complete correlation (A9 for many columns) -----------------------

def _masked_kernel(cols, shift):
    k = len(cols)

    def run(it):
        n, sx, sxx, sxy = (np.zeros((k, k)) for _ in range(4))
        lo, hi = np.full((k, k), np.inf), np.full((k, k), -np.inf)
        seen = False
        for pdf in it:
            if pdf.empty:
                continue
            seen = True
            X = pdf[cols].to_numpy(dtype=np.float64) - shift
            M = (~np.isnan(X)).astype(np.float64)
            X0 = np.nan_to_num(X, nan=0.0)
            n += M.T @ M
            sx += X0.T @ M          # sx[i, j] = sum of x_i over rows where i and j are present
            sxx += (X0 * X0).T @ M
            sxy += X0.T @ X0
            for j in range(k):  # range of every column over the rows where column j is present
                Y = X[M[:, j] > 0]
                lo[:, j] = np.fmin(lo[:, j], np.fmin.reduce(Y, axis=0, initial=np.inf))
                hi[:, j] = np.fmax(hi[:, j], np.fmax.reduce(Y, axis=0, initial=-np.inf))
        if seen:
            cells = np.concatenate([x.ravel() for x in (n, sx, sxx, sxy)])
            spread = np.zeros(cells.size)
            spread[:k * k] = lo.ravel()
            spread[k * k:2 * k * k] = hi.ravel()
            yield pd.DataFrame({"_i": np.arange(cells.size), "_v": cells, "_e": spread})

    return run


def masked_corr(df: DataFrame, cols) -> DataFrame:
    """A9 via one masked-Gram pass: (f1, f2, corr) over rows where both columns are non-null."""
    cols = list(cols)
    k = len(cols)
    base = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    means = base.agg(*[F.avg(c) for c in cols]).first()
    shift = np.array([0.0 if v is None else float(v) for v in means])
    parts = base.mapInPandas(_masked_kernel(cols, shift), "_i long, _v double, _e double")
    sums = parts.groupBy("_i").agg(F.sum("_v").alias("_v"), F.min("_e").alias("_lo"), F.max("_e").alias("_hi")).collect()  # 4 k² cells, bounded by k
    cells, low, high = (np.zeros(4 * k * k) for _ in range(3))
    for r in sums:
        cells[r["_i"]], low[r["_i"]], high[r["_i"]] = r["_v"], r["_lo"], r["_hi"]
    varies = (low[:k * k] < high[k * k:2 * k * k]).reshape(k, k)  # constant exactly when min = max
    n, sx, sxx, sxy = (cells[i * k * k:(i + 1) * k * k].reshape(k, k) for i in range(4))
    out = []
    for i in range(k):
        for j in range(k):
            nn = n[i, j]
            cov = nn * sxy[i, j] - sx[i, j] * sx[j, i]
            vi = nn * sxx[i, j] - sx[i, j] ** 2
            vj = nn * sxx[j, i] - sx[j, i] ** 2
            val = None
            if varies[i, j] and varies[j, i] and vi > 0 and vj > 0:
                val = float(np.clip(cov / np.sqrt(vi * vj), -1.0, 1.0))
            out.append((cols[i], cols[j], val))
    return df.sparkSession.createDataFrame(out, "f1 string, f2 string, corr double")
