import tempfile

from pyspark.sql import functions as F

from skein.operators import linear
from skein.sources import fixtures as fx
from skein.streaming.scoring import score_stream, stream_row_features
from conftest import SF_SMALL


def test_stream_scoring_equals_batch(spark):
    train, test = fx.orders_train_test(spark, SF_SMALL)
    feats = list(fx.P2_FEATURES)
    coefs = linear.fit_ridge(train, ["market"], feats, "target", 1.0)
    src = tempfile.mkdtemp(prefix="skein-stream-src-")
    test.write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema(test.schema).parquet(src)
    scored = score_stream(stream_row_features(stream, fx.P2_SPEC), coefs, ["market"], feats)
    q = (scored.select("id", "pred").writeStream.format("memory").queryName("skein_scored")
         .outputMode("append").start())
    q.processAllAvailable()
    q.stop()
    got = {r["id"]: r["pred"] for r in spark.sql("SELECT * FROM skein_scored").collect()}
    want = {r["id"]: r["pred"] for r in linear.score_linear(test, coefs, ["market"], feats).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) <= 1e-9 * max(1.0, abs(want[k])) for k in want)
