"""Exact grouped quantiles by counting passes, without sorting or shuffling rows.

The values at the needed ranks are narrowed down for all groups, columns and probabilities at once. A pass cuts every
open interval into ``CELLS`` cells by a function that never decreases with the value (logarithmic in the first pass,
linear inside an interval in later ones) and counts rows, smallest and largest value of each cell; these partial
aggregates are combined in each task, so a shuffle carries cells, not rows. The cell that holds a rank becomes the next
interval. An interval is closed when its smallest and largest value are equal (ties of any number close at once) or when it
holds at most ``GATHER`` rows, which one last pass collects.

The first pass leaves a factor of about two between an interval's ends, each further one divides its width by ``CELLS``; as
smallest and largest value always fall into different cells, every pass makes progress. The state is one row for each
interval. A small one (a few groups) is held as a local table, so a call is one job for each pass; a large one is
checkpointed and joined by shuffle.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.operators.sizing import bounded_collect, join_small
from skein.session import ensure_checkpoint_dir

CELLS = 4096
#: Rows of an interval that may be collected into one array.
GATHER = 4096
#: Rows of a state that is held as a local table.
MAX_LOCAL = 20_000
#: ln of the smallest and largest double lies within +-746.
_LOG_REACH = 746.0


def _log_cell(value: str):
    """Cell of any double: its sign and logarithm, cut evenly."""
    v = F.col(value)
    size = F.ln(F.least(F.abs(v), F.lit(1.7e308))) + _LOG_REACH
    signed = F.when(v == 0, F.lit(0.0)).when(v > 0, size).otherwise(-size)
    return F.floor((signed + 2 * _LOG_REACH) / (4 * _LOG_REACH) * CELLS).cast("int")


def _linear_cell(value: str):
    part = (F.col(value) - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
    return F.least(F.floor(part * CELLS), F.lit(CELLS - 1)).cast("int")


def _ranks(n, probs):
    """The ranks that linear interpolation needs, from 0."""
    h = [(n - 1) * F.lit(p) for p in probs]
    return F.array_distinct(F.array(*[x.cast("bigint") for p in h for x in (F.floor(p), F.ceil(p))]))


class _State:
    """A result computed once: its rows where they are few, else a checkpointed frame."""

    def __init__(self, df: DataFrame):
        self.spark, self.schema = df.sparkSession, df.schema
        self.rows = bounded_collect(df, MAX_LOCAL)
        self.df = df.checkpoint(eager=True) if self.rows is None else self.spark.createDataFrame(self.rows, self.schema)
        self.local = self.rows is not None

    def where(self, sql: str, told) -> "_State | None":
        """The rows that ``sql`` (in Python: ``told``) selects; None where it is known without a job that there are none."""
        part = object.__new__(_State)
        part.spark, part.schema, part.local = self.spark, self.schema, self.local
        part.rows = [r for r in self.rows if told(r)] if self.local else None
        if part.rows == []:
            return None
        part.df = self.spark.createDataFrame(part.rows, self.schema) if self.local else self.df.where(sql)
        return None if not self.local and part.df.isEmpty() else part


def _meet(big: DataFrame, small: DataFrame, local: bool, keys) -> DataFrame:
    cols = small.columns
    if not local:
        return join_small(big, small, keys, null_safe=True)
    renamed = small.select(*[F.col(c).alias(f"_k_{c}") if c in keys else F.col(c) for c in cols])
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    return big.join(F.broadcast(renamed), same).drop(*[f"_k_{c}" for c in keys])


def _narrow(cells: DataFrame, keys: list[str], ranks) -> DataFrame:
    """The cells that hold one of ``ranks`` (an expression over the interval's rows ``_all``), with the ranks inside them.
    ``_base`` counts the rows of the group below the interval."""
    inside = Window.partitionBy(*keys)
    below = F.coalesce(F.sum("_n").over(inside.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    c = cells.withColumn("_below", below).withColumn("_all", F.sum("_n").over(inside))
    c = c.withColumn("_ranks", F.filter(F.transform(ranks, lambda r: r - F.col("_below")),
                                        lambda r: (r >= 0) & (r < F.col("_n"))))
    return c.where(F.size("_ranks") > 0)


def exact_quantiles(df: DataFrame, group_cols, cols, probs) -> DataFrame:
    """(group..., column_name, prob, value): linear-interpolated quantiles; nulls are ignored, null groups are groups."""
    from skein.operators.stats import melt
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    group_cols, probs = list(group_cols), [float(p) for p in probs]
    by = [*group_cols, "column_name"]
    wide = df.select(*group_cols, *[F.col(c).cast("double").alias(c) for c in cols]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        long = melt(wide, cols, group_cols)
        counted = [F.count(F.lit(1)).alias("_n"), F.min("value").alias("_lo"), F.max("value").alias("_hi")]
        first = _narrow(long.groupBy(*by, _log_cell("value").alias("_cell")).agg(*counted), by, _ranks(F.col("_all"), probs))
        state = _State(first.select(*by, "_n", "_lo", "_hi", F.col("_all").alias("_total"), F.col("_below").alias("_base"),
                                    "_ranks"))
        found = []
        while True:
            equal = state.where("_lo = _hi", lambda r: r["_lo"] == r["_hi"])
            if equal:
                found.append(equal.df.select(*by, "_total", F.explode(F.transform("_ranks", lambda r: F.struct(
                    (r + F.col("_base")).alias("_rank"), F.col("_lo").alias("_x")))).alias("_p")))
            few = state.where(f"_lo < _hi and _n <= {GATHER}", lambda r: r["_lo"] < r["_hi"] and r["_n"] <= GATHER)
            if few:
                found.append(_gathered(long, few, by))
            wide_open = state.where(f"_lo < _hi and _n > {GATHER}", lambda r: r["_lo"] < r["_hi"] and r["_n"] > GATHER)
            if not wide_open:
                break
            now = wide_open.df
            rows = _meet(long, now.select(*by, "_lo", "_hi"), wide_open.local, by).where("value between _lo and _hi")
            cells = rows.groupBy(*by, F.col("_lo").alias("_from"), _linear_cell("value").alias("_cell")).agg(*counted)
            told = now.select(*by, F.col("_lo").alias("_from"), F.col("_ranks").alias("_want"), "_total", "_base")
            cells = _meet(cells, told, wide_open.local, [*by, "_from"])
            state = _State(_narrow(cells, [*by, "_from"], F.col("_want")).select(
                *by, "_n", "_lo", "_hi", "_total", (F.col("_base") + F.col("_below")).alias("_base"), "_ranks"))
        if not found:
            return first.select(*by, F.lit(0.0).alias("prob"), F.col("_lo").alias("value")).limit(0)
        out = found[0]
        for part in found[1:]:
            out = out.union(part)
        return _State(_interpolated(out.select(*by, "_total", "_p.*"), by, probs)).df
    finally:
        wide.unpersist()


def _gathered(long: DataFrame, state: _State, by) -> DataFrame:
    """Ranks of the intervals with few rows, from their sorted values."""
    rows = _meet(long, state.df.select(*by, "_lo", "_hi"), state.local, by).where("value between _lo and _hi")
    held = rows.groupBy(*by, "_lo").agg(F.sort_array(F.collect_list("value")).alias("_xs"))
    held = _meet(held, state.df.select(*by, "_lo", "_total", "_base", "_ranks"), state.local, [*by, "_lo"])
    return held.select(*by, "_total", F.explode(F.transform("_ranks", lambda r: F.struct(
        (r + F.col("_base")).alias("_rank"), F.get("_xs", r.cast("int")).alias("_x")))).alias("_p"))


def _interpolated(found: DataFrame, by, probs) -> DataFrame:
    at = found.groupBy(*by).agg(F.first("_total").alias("_total"), F.map_from_entries(
        F.array_distinct(F.collect_list(F.struct("_rank", "_x")))).alias("_at"))
    h = (F.col("_total") - 1) * F.col("prob")
    lo, hi = (F.element_at("_at", f(h).cast("bigint")) for f in (F.floor, F.ceil))
    return at.select(*by, "_total", "_at", F.explode(F.array(*[F.lit(p) for p in probs])).alias("prob")).select(
        *by, "prob", (lo + (h - F.floor(h)) * (hi - lo)).alias("value"))
