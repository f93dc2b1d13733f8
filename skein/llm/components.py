"""Connected components of an edge table by alternating large-star and small-star steps.

Each step sends one row for an edge and takes a minimum by key, so a hub costs rows in proportion to its edges and is
combined before the shuffle. Every round is stored, which ends its lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skein.llm.textops import store


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``node, root`` for every node of the undirected edges ``a, b`` (long); root is the smallest node reachable."""
    now = store(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                label)
    state = _state(now)
    while state[0]:
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(
            F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").where("a <> b").distinct()
        now = store(small, label)
        after = _state(now)
        if after == state:
            break
        state = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select("b", "b").distinct()).toDF("node", "root")
