"""Projections, filters, key joins, set ops, sort/limit/sample (P*, J*, U*, O*)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.spec import PanelSpec


# -- P ------------------------------------------------------------------------

def project(df: DataFrame, cols) -> DataFrame:
    """Column projection by list."""
    return df.select(*cols)


def drop_if_present(df: DataFrame, cols) -> DataFrame:
    """Drop named columns; names not in the frame are ignored."""
    return df.drop(*[c for c in cols if c in df.columns])


def drop_null_rows(df: DataFrame, subset=None) -> DataFrame:
    """P4 (subset) / P5 (any column): drop rows with NULL (NaN was folded to NULL at source)."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


def filter_market(df: DataFrame, spec: PanelSpec, market: str) -> DataFrame:
    """Rows of one market."""
    return df.where(F.col(spec.market) == F.lit(market))


def split_labelled(df: DataFrame, spec: PanelSpec = PanelSpec()):
    """(rows with a target, rows without one)."""
    t = F.col(spec.target)
    return df.where(t.isNotNull()), df.where(t.isNull())


def fill_zero(df: DataFrame, cols) -> DataFrame:
    """NULL -> 0 in ``cols``; a column missing from the frame is added as 0."""
    have = set(df.columns)
    fill = [c for c in cols if c in have]
    out = df.fillna(0.0, subset=fill) if fill else df
    add = [c for c in cols if c not in have]
    return out.select("*", *[F.lit(0.0).alias(c) for c in add]) if add else out


def temporal_split(df: DataFrame, spec: PanelSpec = PanelSpec(), val_months: int = 3):
    """P10: cutoff = max(time) - ``val_months`` months; train < cutoff <= validation.

    The cutoff is one scalar from one aggregate.
    """
    last = df.agg(F.max(spec.time)).first()[0]
    if last is None:
        return df.limit(0), df.limit(0)
    cutoff = F.lit(last).cast("timestamp_ntz") - F.make_interval(months=F.lit(val_months))
    t = F.col(spec.time)
    return df.where(t < cutoff), df.where(t >= cutoff)


def complete_rows(df: DataFrame, cols) -> DataFrame:
    """Rows valid in every listed column (index intersection of X and y)."""
    cond = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols], F.lit(True))
    return df.where(cond)


# -- J ------------------------------------------------------------------------

def attach_predictions(rows: DataFrame, preds: DataFrame, id_col: str = "id",
                       pred_col: str = "pred") -> DataFrame:
    """Predictions keyed by id joined to their rows (no positional pasting)."""
    return rows.join(preds.select(id_col, pred_col), id_col, "inner")


def align_predictions(a: DataFrame, b: DataFrame, id_col: str = "id", value_col: str = "target",
                      names=("a", "b")) -> DataFrame:
    """Full outer join of two prediction sets on id -> (id, a, b, side).

    ``side`` is 'both', 'only_a' or 'only_b'; the original workflow demands equal id lists.
    """
    na, nb = names
    left = a.select(F.col(id_col), F.col(value_col).alias(na), F.lit(True).alias("_in_a"))
    right = b.select(F.col(id_col), F.col(value_col).alias(nb), F.lit(True).alias("_in_b"))
    j = left.join(right, id_col, "full_outer")
    side = (F.when(F.col("_in_a").isNotNull() & F.col("_in_b").isNotNull(), F.lit("both"))
            .when(F.col("_in_a").isNotNull(), F.lit(f"only_{na}")).otherwise(F.lit(f"only_{nb}")))
    return j.select(id_col, na, nb, side.alias("side"))


def alignment_report(aligned: DataFrame) -> DataFrame:
    """J2 report: row count per side."""
    return aligned.groupBy("side").agg(F.count(F.lit(1)).alias("n_rows"))


def ids_not_in(a: DataFrame, b: DataFrame, id_col: str = "id") -> DataFrame:
    """Distinct ids of ``a`` absent from ``b``."""
    return a.select(id_col).distinct().join(b.select(id_col), id_col, "left_anti")


# -- U ------------------------------------------------------------------------

def stack(frames) -> DataFrame:
    """Stack frames by column name."""
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), list(frames))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of a column."""
    return df.select(col).distinct()


# -- O ------------------------------------------------------------------------

def sort_rows(df: DataFrame, cols) -> DataFrame:
    """O1: ascending sort, NULLs last (output only)."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in cols])


def top_k(df: DataFrame, value_col: str, k: int, tie_col: str | None = None) -> DataFrame:
    """O2: k rows with the largest ``value_col`` (ties by ``tie_col``) -> TakeOrdered."""
    order = [F.col(value_col).desc_nulls_last()]
    if tie_col:
        order.append(F.col(tie_col).asc_nulls_last())
    return df.orderBy(*order).limit(k)


def above(df: DataFrame, col: str, threshold: float) -> DataFrame:
    """O3: rows whose ``col`` exceeds ``threshold``."""
    return df.where(F.col(col) > F.lit(threshold))


def seeded_sample(df: DataFrame, n: int, id_col: str = "id", seed: int = 42) -> DataFrame:
    """At most ``n`` rows chosen by a seeded hash of the id (same rows on any partitioning)."""
    h = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))
    return df.orderBy(h, F.col(id_col)).limit(n)
