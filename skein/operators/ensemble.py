"""Prediction ensembles (N1 mean, N2 inverse-MAE weights), keyed by id."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _joined(preds: dict, id_col: str, value_col: str) -> DataFrame:
    frames = [df.select(F.col(id_col), F.col(value_col).alias(name)) for name, df in preds.items()]
    return reduce(lambda a, b: a.join(b, id_col, "inner"), frames)


def mean_ensemble(preds: dict, id_col: str = "id", value_col: str = "target") -> DataFrame:
    """Per-id mean of k prediction sets (ids present in every set)."""
    names = list(preds)
    j = _joined(preds, id_col, value_col)
    total = reduce(lambda a, b: a + b, [F.col(n) for n in names])
    return j.select(id_col, (total / F.lit(float(len(names)))).alias(value_col))


def inverse_mae_weights(maes: dict) -> dict:
    """w_i = (1 / MAE_i) / sum_j (1 / MAE_j); for two models w_a = MAE_b / (MAE_a + MAE_b)."""
    perfect = [k for k, v in maes.items() if float(v) == 0.0]
    if perfect:  # models without error share the whole weight
        return {k: 1.0 / len(perfect) if k in perfect else 0.0 for k in maes}
    inv = {k: 1.0 / float(v) for k, v in maes.items()}
    total = sum(inv.values())
    return {k: v / total for k, v in inv.items()}


def weighted_ensemble(preds: dict, weights: dict, id_col: str = "id",
                      value_col: str = "target") -> DataFrame:
    """Per-id weighted sum of prediction sets."""
    j = _joined(preds, id_col, value_col)
    total = reduce(lambda a, b: a + b, [F.lit(float(weights[n])) * F.col(n) for n in preds])
    return j.select(id_col, total.alias(value_col))


def mae_table(scored: dict, y: str = "target", p: str = "pred") -> DataFrame:
    """MAE of each model on its validation rows, as (model, mae) - the input of N2."""
    parts = [df.agg(F.avg(F.abs(F.col(y) - F.col(p))).alias("mae")).select(F.lit(name).alias("model"), "mae")
             for name, df in scored.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def inverse_mae_ensemble(preds: dict, maes: DataFrame, id_col: str = "id",
                         value_col: str = "target") -> DataFrame:
    """N2 with weights from an (model, mae) table (k rows, read once)."""
    weights = inverse_mae_weights({r["model"]: r["mae"] for r in maes.collect()})
    return weighted_ensemble(preds, weights, id_col, value_col)
