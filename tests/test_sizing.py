"""Small sides are bounded by rows and by bytes; beyond either the join shuffles with the same result."""

from pyspark.sql import functions as F

from skein.operators.sizing import as_local, join_small


def test_wide_rows_are_not_broadcast(spark):
    small = spark.range(50).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 1000).alias("v"),
                                   F.array(F.lit(1.0), F.lit(2.0)).alias("a"))
    assert as_local(small, 100, 100_000).count() == 50
    assert as_local(small, 100, 20_000) is None
    assert as_local(small, 49, 100_000) is None
    assert as_local(small.limit(0)).count() == 0
    big = spark.range(200).select((F.col("id") % 60).alias("k"))
    near, far = join_small(big, small, ["k"]), join_small(big, small, ["k"], max_bytes=20_000)
    assert sorted(map(tuple, near.select("k").collect())) == sorted(map(tuple, far.select("k").collect()))
    assert near.count() == 170
    nulls = spark.createDataFrame([(None, 1), (2, 3)], "k long, w int")
    got = join_small(nulls, nulls.withColumnRenamed("w", "u"), ["k"], null_safe=True, max_bytes=1)
    assert sorted(r["u"] for r in got.collect()) == [1, 3]
