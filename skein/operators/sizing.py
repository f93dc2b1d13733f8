"""Joins with a small side whose size is proven before it is broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side with at most this many rows and bytes is collected once and broadcast.
MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 << 20


def bounded_collect(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS):
    """Collect ``df`` only if it has at most ``max_rows`` rows; else return None.

    ``limit(max_rows + 1)`` stops the scan early, so an oversized side costs no
    more than ``max_rows + 1`` rows on the driver.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return None
    return rows


def _value_bytes(v) -> int:
    """About what a collected value takes in a row: 8 bytes and its text, or the sum of its parts."""
    if isinstance(v, (str, bytes, bytearray)):
        return 8 + len(v)
    if isinstance(v, dict):
        return 8 + sum(_value_bytes(x) for pair in v.items() for x in pair)
    if isinstance(v, (list, tuple)):
        return 8 + sum(map(_value_bytes, v))
    return 8


def as_local(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame | None:
    """Materialise a small result as a local relation (computed once), or None if it has too many rows or bytes. Rows
    come to the driver one partition after the other and are given up as soon as they exceed either."""
    rows, size = [], 0
    for row in df.limit(max_rows + 1).toLocalIterator():
        rows.append(row)
        size += _value_bytes(row)
        if size > max_bytes or len(rows) > max_rows:
            rows = None
            break
    if rows is None:
        return None
    return df.sparkSession.createDataFrame(rows, df.schema)


def join_small(big: DataFrame, small: DataFrame, keys, how: str = "inner",
               null_safe: bool = False, max_rows: int = MAX_BROADCAST_ROWS,
               max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Join ``big`` with ``small`` on ``keys``; broadcast ``small`` only after its rows and bytes are checked.

    Beyond ``max_rows`` or ``max_bytes`` the join falls back to a regular shuffle join.
    """
    keys = list(keys)
    local = as_local(small, max_rows, max_bytes)
    right = F.broadcast(local) if local is not None else small
    if not null_safe:
        return big.join(right, keys, how)
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c)
                             for c in right.columns])
    cond = None
    for k in keys:
        term = big[k].eqNullSafe(renamed[f"_r_{k}"])
        cond = term if cond is None else cond & term
    return big.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])
