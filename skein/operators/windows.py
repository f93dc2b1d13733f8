"""Ordered window features within each market (W1-W7) and ffill/bfill.

Every frame is positional (rows), ordered by (time, id), as in the original workflow.

Two physical strategies, identical results:

* ``plain``: ``Window.partitionBy(market)`` - one exchange + sort; a market is one task.
* ``bucketed``: exact per-market positions (``with_positions``), buckets of
  ``bucket_rows`` consecutive rows, and each bucket receives the last ``L`` rows of
  the previous bucket as a halo (``L`` = the longest frame). Windows run per
  (market, bucket), halo rows are dropped. A hot market becomes many tasks.
  Unbounded frames (ffill/bfill) carry the last/first non-null value of earlier/later
  buckets through a small (market, bucket) table.

``auto`` measures the largest market (one small aggregate) and picks ``plain`` while
it fits ``bucket_rows``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.session import wide_plan_guard
from skein.operators.positions import with_positions
from skein.operators.sizing import join_small
from skein.spec import LAG_HOURS, ROLLING_WINDOWS, WEATHER_LAGS, PanelSpec

DEFAULT_BUCKET_ROWS = 250_000
_POS = "_pos"
_BUCKET = "_bucket"
_HALO = "_halo"


def _conf_strategy(df: DataFrame, strategy: str | None, bucket_rows: int | None):
    conf = df.sparkSession.conf
    strategy = strategy or conf.get("skein.window.strategy", "auto")
    bucket_rows = bucket_rows or int(conf.get("skein.window.bucketRows", str(DEFAULT_BUCKET_ROWS)))
    return strategy, bucket_rows


def choose_strategy(df: DataFrame, spec: PanelSpec, strategy: str | None = None,
                    bucket_rows: int | None = None):
    strategy, bucket_rows = _conf_strategy(df, strategy, bucket_rows)
    if strategy == "auto":
        biggest = df.groupBy(spec.market).count().agg(F.max("count")).first()[0] or 0
        strategy = "plain" if biggest <= bucket_rows else "bucketed"
    if strategy not in ("plain", "bucketed"):
        raise ValueError(f"Unknown window strategy: {strategy}")
    return strategy, bucket_rows


def _reversed(spec: PanelSpec) -> Window:
    """The market window in exactly reversed (time, id) order."""
    return Window.partitionBy(spec.market).orderBy(
        F.col(spec.time).desc_nulls_first(), F.col(spec.id).desc_nulls_first())


def _guard(spec: PanelSpec, e: Column) -> Column:
    """Rows with a null market belong to no series (pandas drops null group keys)."""
    return F.when(F.col(spec.market).isNotNull(), e)


class _Frame:
    """Builds window expressions against either the plain or the bucketed window."""

    def __init__(self, w: Window):
        self.w = w

    def lag(self, c: str, n: int) -> Column:
        return F.lag(F.col(c), n).over(self.w)

    def roll_mean(self, c: str, k: int) -> Column:
        return F.avg(F.col(c)).over(self.w.rowsBetween(-k, -1))

    def roll_std(self, c: str, k: int) -> Column:
        return F.stddev_samp(F.col(c)).over(self.w.rowsBetween(-k, -1))

    def diff(self, c: str) -> Column:
        return F.col(c) - F.lag(F.col(c), 1).over(self.w)


def _named_exprs(frame: _Frame, spec: PanelSpec, lags: dict, rolling: dict, diffs) -> list:
    out = []
    for c, ns in lags.items():
        for n in ns:
            out.append(_guard(spec, frame.lag(c, n)).alias(f"{c}_lag_{n}h"))
    for c, ks in rolling.items():
        for k in ks:
            out.append(_guard(spec, frame.roll_mean(c, k)).alias(f"{c}_roll_mean_{k}h"))
            out.append(_guard(spec, frame.roll_std(c, k)).alias(f"{c}_roll_std_{k}h"))
    for c in diffs:
        out.append(_guard(spec, frame.diff(c)).alias(f"{c}_diff"))
    return out


def _reach(lags: dict, rolling: dict, diffs) -> int:
    reach = [n for ns in lags.values() for n in ns] + [k for ks in rolling.values() for k in ks]
    if diffs:
        reach.append(1)
    return max(reach) if reach else 0


def _with_buckets(df: DataFrame, spec: PanelSpec, bucket_rows: int, halo: int) -> DataFrame:
    """Positions, bucket ids and halo copies of the last ``halo`` rows of each bucket."""
    size = max(bucket_rows, halo, 1)
    pos = with_positions(df, [spec.market], [spec.time, spec.id], pos_col=_POS)
    b = F.floor(F.col(_POS) / size).cast("long")
    own = F.struct(b.alias("b"), F.lit(False).alias("h"))
    nxt = F.struct((b + 1).alias("b"), F.lit(True).alias("h"))
    tagged = F.when((F.col(_POS) % size) >= (size - halo), F.array(own, nxt)).otherwise(F.array(own))
    return (pos.withColumn("_bt", F.explode(tagged))
            .withColumn(_BUCKET, F.col("_bt.b")).withColumn(_HALO, F.col("_bt.h")).drop("_bt"))


def window_features(df: DataFrame, spec: PanelSpec = PanelSpec(), lags: dict | None = None,
                    rolling: dict | None = None, diffs=(), strategy: str | None = None,
                    bucket_rows: int | None = None) -> DataFrame:
    """Add lag / rolling mean+std / first-difference columns in ONE window pass.

    ``lags``: {column: [n, ...]} -> ``{c}_lag_{n}h``; ``rolling``: {column: [k, ...]} ->
    ``{c}_roll_mean_{k}h`` and ``{c}_roll_std_{k}h`` over the k previous rows (current
    row excluded, nulls skipped, sample std); ``diffs``: columns -> ``{c}_diff``.
    """
    lags, rolling, diffs = dict(lags or {}), dict(rolling or {}), list(diffs)
    if not lags and not rolling and not diffs:
        return df
    wide_plan_guard(df.sparkSession)
    strategy, bucket_rows = choose_strategy(df, spec, strategy, bucket_rows)
    cols = [F.col(c) for c in df.columns]
    if strategy == "plain":
        return df.select(*cols, *_named_exprs(_Frame(spec.window()), spec, lags, rolling, diffs))
    halo = _reach(lags, rolling, diffs)
    staged = _with_buckets(df, spec, bucket_rows, halo)
    w = Window.partitionBy(spec.market, _BUCKET).orderBy(F.col(_POS))
    feats = _named_exprs(_Frame(w), spec, lags, rolling, diffs)
    return staged.select(*cols, _HALO, *feats).where(~F.col(_HALO)).drop(_HALO)


# -- W1-W6 wrappers -------------------------------------------------------------

def add_lag_features(df: DataFrame, spec: PanelSpec = PanelSpec(), lags=None, **kw) -> DataFrame:
    """Target lags within market (positional, default LAG_HOURS)."""
    return window_features(df, spec, lags={spec.target: list(LAG_HOURS if lags is None else lags)}, **kw)


def add_rolling_features(df: DataFrame, spec: PanelSpec = PanelSpec(), windows=None,
                         **kw) -> DataFrame:
    """Rolling mean and sample std of the target over the previous k rows."""
    return window_features(df, spec, rolling={spec.target: list(ROLLING_WINDOWS if windows is None else windows)}, **kw)


def add_weather_lags(df: DataFrame, spec: PanelSpec = PanelSpec(), lags=None, cols=None,
                     **kw) -> DataFrame:
    """Lags of weather columns; columns absent from the frame are skipped."""
    cols = [c for c in (WEATHER_LAGS if cols is None else cols) if c in df.columns]
    lags = LAG_HOURS if lags is None else lags
    return window_features(df, spec, lags={c: list(lags) for c in cols}, **kw)


def add_variable_lags(df: DataFrame, spec: PanelSpec, variable, lags=None, **kw) -> DataFrame:
    """Lags of one variable (``variable``, ``lags``) or of a dict {variable: lags}."""
    config = dict(variable) if isinstance(variable, dict) else {variable: list(lags)}
    return window_features(df, spec, lags=config, **kw)


def first_difference(df: DataFrame, spec: PanelSpec, col: str, drop_first: bool = True,
                     **kw) -> DataFrame:
    """``col - lag(col, 1)`` per market as ``{col}_diff``; first row dropped."""
    out = window_features(df, spec, diffs=[col], **kw)
    return out.where(F.col(f"{col}_diff").isNotNull()) if drop_first else out


# -- W7 -----------------------------------------------------------------------

def row_position(df: DataFrame, spec: PanelSpec = PanelSpec(), order: str = "time",
                 name: str = "row_pos") -> DataFrame:
    """0-based position of each row, no gaps.

    ``order='panel'``: market-major (market, time, id) order, as rows sit after the
    feature steps of the original workflow; ``order='time'``: (time, market, id) order.
    Never a single-partition window over data rows: positions come from range
    partitioning plus a small offset table.
    """
    if order == "panel":
        keys = [spec.market, spec.time, spec.id]
    elif order == "time":
        keys = [spec.time, spec.market, spec.id]
    else:
        raise ValueError(f"Unknown order: {order}")
    return with_positions(df, [], keys, pos_col=name)


# -- I1 -----------------------------------------------------------------------

def fill_forward_backward(df: DataFrame, spec: PanelSpec = PanelSpec(), cols=None,
                          backfill: bool = True, strategy: str | None = None,
                          bucket_rows: int | None = None) -> DataFrame:
    """Per market, last non-null value at or before the row, else first after.

    An all-null market stays null; null-market rows become null (no series).
    """
    cols = [c for c in (cols or spec.features) if c in df.columns]
    strategy, bucket_rows = choose_strategy(df, spec, strategy, bucket_rows)
    wanted = set(cols)
    if strategy == "plain":
        w = spec.window()
        past = w.rowsBetween(Window.unboundedPreceding, 0)
        # Backward fill = forward fill in reversed order: an unbounded-PRECEDING frame is
        # evaluated incrementally, while an unbounded-following frame is re-aggregated for
        # every row (quadratic in the market size).
        future = _reversed(spec).rowsBetween(Window.unboundedPreceding, 0)

        def filled(c):
            fwd = F.last(F.col(c), ignorenulls=True).over(past)
            e = F.coalesce(fwd, F.last(F.col(c), ignorenulls=True).over(future)) if backfill else fwd
            return _guard(spec, e).alias(c)

        return df.select(*[filled(c) if c in wanted else F.col(c) for c in df.columns])

    size = max(bucket_rows, 1)
    staged = with_positions(df, [spec.market], [spec.time, spec.id], pos_col=_POS)
    staged = staged.withColumn(_BUCKET, F.floor(F.col(_POS) / size).cast("long"))
    # Small table: last / first non-null value of each column per (market, bucket).
    edge = staged.groupBy(spec.market, _BUCKET).agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(_POS))).alias(f"_l_{c}") for c in cols],
        *[F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(_POS))).alias(f"_f_{c}") for c in cols],
    )
    bw = Window.partitionBy(spec.market).orderBy(_BUCKET)
    carry = edge.select(
        spec.market, _BUCKET,
        *[F.last(f"_l_{c}", ignorenulls=True).over(bw.rowsBetween(Window.unboundedPreceding, -1))
          .alias(f"_cl_{c}") for c in cols],
        *[F.first(f"_f_{c}", ignorenulls=True).over(bw.rowsBetween(1, Window.unboundedFollowing))
          .alias(f"_cf_{c}") for c in cols],
    )
    joined = join_small(staged, carry, [spec.market, _BUCKET], null_safe=True)
    w = Window.partitionBy(spec.market, _BUCKET).orderBy(_POS)
    past = w.rowsBetween(Window.unboundedPreceding, 0)
    future = Window.partitionBy(spec.market, _BUCKET).orderBy(F.col(_POS).desc()).rowsBetween(
        Window.unboundedPreceding, 0)

    def filled_b(c):
        parts = [F.last(F.col(c), ignorenulls=True).over(past), F.col(f"_cl_{c}")]
        if backfill:
            parts += [F.last(F.col(c), ignorenulls=True).over(future), F.col(f"_cf_{c}")]
        return _guard(spec, F.coalesce(*parts)).alias(c)

    return joined.select(*[filled_b(c) if c in wanted else F.col(c) for c in df.columns])
