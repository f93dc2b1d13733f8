import tempfile

import pytest
from pyspark.sql import functions as F

from skein.sources import fixtures as fx
from skein.sources import panel_io
from conftest import SF_SMALL


def test_csv_panel_round_trip_text_dates_and_predictions(spark):
    spec = fx.P2_SPEC
    panel = fx.orders_panel(spark, SF_SMALL)
    out = tempfile.mkdtemp(prefix="skein-src-")
    (panel.select(*[f.name for f in panel_io.panel_schema(spec).fields])
     .write.mode("overwrite").option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
     .csv(f"{out}/train"))
    back = panel_io.read_panel(spark, f"{out}/train", spec, fmt="csv")
    text = panel_io.read_panel_text_dates(spark, f"{out}/train", spec)
    cols = ["id", "market", "delivery_start", "target", *spec.features]
    want = sorted(tuple(r) for r in panel.select(*cols).collect())
    assert sorted(tuple(r) for r in back.select(*cols).collect()) == want
    assert sorted(tuple(r) for r in text.select(*cols).collect()) == want

    preds = panel.select("id", F.col("target"))
    panel_io.write_predictions(preds.where(F.col("target").isNotNull()), f"{out}/pred")
    read = panel_io.read_predictions(spark, f"{out}/pred")
    n = preds.where(F.col("target").isNotNull()).count()
    rep = panel_io.validate_predictions(read, expected_rows=n)
    assert rep["n_rows"] == n and rep["n_null"] == 0
    with pytest.raises(AssertionError):
        panel_io.validate_predictions(read, expected_rows=n + 1)
    with_gaps = fx.hourly_events_panel(spark, SF_SMALL).select("id", "target")  # empty hours: NULL
    with pytest.raises(AssertionError):
        panel_io.validate_predictions(with_gaps)
    shape = panel_io.shape_report(back).first()
    assert shape["n_rows"] == panel.count() and shape["n_columns"] == len(back.columns)
