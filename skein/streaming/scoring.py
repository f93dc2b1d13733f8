"""Scoring on a streaming DataFrame.

The original workflow reads files once; nothing in it is stateful over time. What carries
over to Structured Streaming unchanged are the row-level features (F1-F8) and the
linear scoring (L3/L12): a stream-static join with the small coefficient table.
Window features need past rows and are not offered on streams.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from skein.functions import features as feat
from skein.operators.linear import score_linear
from skein.spec import PanelSpec


def stream_row_features(stream: DataFrame, spec: PanelSpec = PanelSpec(), squared=None,
                        interactions=None) -> DataFrame:
    """Stateless features on a stream: calendar (F1), squares (F7 rules) and interactions (F8)."""
    out = feat.add_temporal_features(stream, spec)
    out = feat.add_squared_features(out, squared or [], missing="skip")
    have = set(out.columns)
    return feat.add_interaction_features(out, [(a, b) for a, b in (interactions or []) if a in have and b in have])


def score_stream(stream: DataFrame, coefs: DataFrame, group_cols, features, pred: str = "pred") -> DataFrame:
    """L3/L12 on a stream: rows keep their id; an unmodelled market scores NULL."""
    return score_linear(stream, coefs, list(group_cols), list(features), pred)
