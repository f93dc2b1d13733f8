"""Exact row positions within groups without sorting a whole group in one task.

``with_positions`` gives every row its 0-based rank inside its group under a
total order. The rows are range-partitioned on (group, order) so a hot group is
spread over many tasks; each task sorts its slice; a small table of
(partition, group) counts — at most #partitions + #groups rows, because range
partitions hold contiguous key ranges — turns local indices into group ranks.

The shuffled, numbered frame is checkpointed once (reliable storage named by
``spark.checkpoint.dir``), so the numbering is computed exactly once, survives
executor loss and feeds both the count table and the final join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.operators.sizing import join_small
from skein.session import ensure_checkpoint_dir

_PARTITION_SHIFT = 33  # monotonically_increasing_id puts the partition id above bit 33


def _order_exprs(order_cols) -> list[Column]:
    out = []
    for c in order_cols:
        out.append(c if isinstance(c, Column) else F.col(c).asc_nulls_last())
    return out


def with_positions(df: DataFrame, partition_cols, order_cols, pos_col: str = "_pos",
                   count_col: str | None = None, num_partitions: int | None = None,
                   checkpoint: bool = True) -> DataFrame:
    """Add ``pos_col`` = 0-based row number within ``partition_cols`` in ``order_cols`` order.

    ``count_col`` (optional) receives the group size. Null group keys form their own
    group (null-safe join). Ties in ``order_cols`` get distinct adjacent positions.
    """
    spark = df.sparkSession
    partition_cols = list(partition_cols)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_last() for c in partition_cols] + _order_exprs(order_cols)
    numbered = (
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("_pid", F.spark_partition_id())
    )
    numbered = numbered.withColumn(
        "_local", F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), _PARTITION_SHIFT)
    ).drop("_mid")
    if checkpoint:
        ensure_checkpoint_dir(spark)
        numbered = numbered.checkpoint(eager=True)

    group_w = Window.partitionBy(*partition_cols) if partition_cols else Window.partitionBy()
    small = numbered.groupBy("_pid", *partition_cols).agg(
        F.count(F.lit(1)).alias("_cnt"), F.min("_local").alias("_first"))
    small = small.select(
        "_pid", *partition_cols,
        (F.coalesce(F.sum("_cnt").over(group_w.orderBy("_pid").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)) - F.col("_first")).alias("_off"),
        F.sum("_cnt").over(group_w).alias("_gcount"),
    )
    joined = join_small(numbered, small, ["_pid", *partition_cols], null_safe=True)
    out = joined.withColumn(pos_col, F.col("_local") + F.col("_off"))
    if count_col:
        out = out.withColumnRenamed("_gcount", count_col)
    else:
        out = out.drop("_gcount")
    return out.drop("_local", "_off", "_pid")
