"""Registered queries: one per operator, each with its DuckDB oracle where SQL can express it.

Every query reads the driver tables through the fixture panels and runs the
operator through the library. Non-exact floating outputs (std, correlations,
fitted values) are rounded identically on both sides with ``rnd``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions import features as feat
from skein.operators import encode, ensemble, evaluate, impute, relational as rel, stats, windows
from skein.plans.oracle_sql import rnd, with_p1, with_p2
from skein.session import ensure_checkpoint_dir
from skein.sources import fixtures as fx
from skein.sources import panel_io
from skein.spec import DROP_COLS, LAG_HOURS, MONTH_NAMES, PRIME_MORNING_HOURS, PRIME_NIGHT_HOURS, ROLLING_WINDOWS, panel_schema

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r4(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c * 1e4 + 0.5) / 1e4


P1 = fx.P1_SPEC
P2 = fx.P2_SPEC
P1F = list(fx.P1_FEATURES)
P2F = list(fx.P2_FEATURES)
W = "PARTITION BY market ORDER BY delivery_start, id"


def _p1l(spark, sf):
    """P1 rows with a target (P4), the series the window features run on."""
    return rel.drop_null_rows(fx.hourly_events_panel(spark, sf), [P1.target])


P1L = "p1l AS (SELECT * FROM p1 WHERE target IS NOT NULL)"


# -- S ------------------------------------------------------------------------

def _table_path(spark, label: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"


@query("s1_load_panel", with_p2("SELECT * FROM p2"))
def s1_load_panel(spark, sf):
    """The panel written as CSV and read back with its schema."""
    path = _table_path(spark, "panel")
    panel_io.write_panel(fx.orders_panel(spark, sf), path, P2)
    return panel_io.read_panel(spark, path, P2).select("id", "market", "delivery_start", "delivery_end", "target", *P2F)


@query("s2_text_dates", with_p1("SELECT * FROM p1"))
def s2_text_dates(spark, sf):
    """The hourly panel, with its gaps, written as CSV and read back with dates as text."""
    path = _table_path(spark, "panel")
    panel_io.write_panel(fx.hourly_events_panel(spark, sf), path, P1)
    return panel_io.read_panel_text_dates(spark, path, P1).select(
        "id", "market", "delivery_start", "delivery_end", "target", *P1F)


@query("s3_s4_prediction_round_trip", with_p2("SELECT id, target FROM p2"))
def s3_s4_prediction_round_trip(spark, sf):
    """Predictions written as CSV part files and read back."""
    path = _table_path(spark, "predictions")
    panel_io.write_predictions(fx.orders_panel(spark, sf), path)
    return panel_io.read_predictions(spark, path)


def _damaged_panel(spark, sf):
    """The order panel as lines of text with known damage: by id, a wrong number, a wrong time, a line cut short, a line
    with a field too many and an absent id. Read back with its rejects."""
    names = [f.name for f in panel_schema(P2).fields]
    p = fx.orders_panel(spark, sf)
    every = lambda n: F.pmod("id", F.lit(n)) == 0
    text = {c: F.coalesce(F.date_format(c, "yyyy-MM-dd HH:mm:ss") if c in (P2.time, P2.end) else F.col(c).cast("string"), F.lit(""))
            for c in names}
    text["target"] = F.when(every(97), "n/a").otherwise(text["target"])
    text["load_forecast"] = F.when(every(89), "1.2.3").when(every(7), "NaN").otherwise(text["load_forecast"])
    text[P2.time] = F.when(every(83), "2001-13-45").otherwise(text[P2.time])
    text["id"] = F.when(every(101), "").otherwise(text["id"])
    line = F.concat_ws(",", *[text[c] for c in names])
    line = F.when(every(79), F.concat(line, F.lit(",9"))).when(every(73), F.substring_index(line, ",", len(names) - 1)).otherwise(line)
    path = _table_path(spark, "damaged")
    # each part file starts with the header line, as a directory of CSV files does
    with_header = p.select(line.alias("value")).mapInArrow(_with_header(",".join(names)), "value string")
    with_header.write.text(path)
    return panel_io.read_panel_checked(spark, path, P2)


def _with_header(header: str):
    def run(batches):
        import pyarrow as pa
        for i, batch in enumerate(batches):
            if not i:
                yield pa.RecordBatch.from_arrays([pa.array([header])], schema=batch.schema)
            yield batch
    return run


_DAMAGE = "damage AS (" + " UNION ALL ".join(
    f"SELECT id, '{field}' AS field FROM p2 WHERE {rule}" for field, rule in (
        ("_row", "id % 79 = 0 OR id % 73 = 0"), ("id", "id % 101 = 0"), ("target", "id % 97 = 0"),
        ("load_forecast", "id % 89 = 0"), (P2.time, "id % 83 = 0"))) + ")"


@query("s1_reject_report", with_p2(
    "SELECT field, count(*) AS n_rows, min(CASE WHEN id % 101 <> 0 THEN id END) AS min_id,"
    " max(CASE WHEN id % 101 <> 0 THEN id END) AS max_id FROM damage GROUP BY field",
    extra=_DAMAGE))
def s1_reject_report(spark, sf):
    return panel_io.reject_report(_damaged_panel(spark, sf))


@query("s1_accepted_rows", with_p2(
    "SELECT id, market, delivery_start, delivery_end, target,"
    " CASE WHEN id % 7 <> 0 THEN load_forecast END AS load_forecast, wind_forecast, solar_forecast, air_temperature_2m,"
    " wind_speed_10m FROM p2 WHERE id NOT IN (SELECT id FROM damage)", extra=_DAMAGE))
def s1_accepted_rows(spark, sf):
    return panel_io.accepted_rows(_damaged_panel(spark, sf))


@query("s5_prediction_report", with_p2(
    "SELECT count(*) AS n_rows, count(DISTINCT id) AS n_distinct_ids, min(id) AS min_id, max(id) AS max_id,"
    " CAST(sum(CASE WHEN target IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_null,"
    " CAST(sum(CASE WHEN target IS NOT NULL AND (isnan(target) OR isinf(target)) THEN 1 ELSE 0 END) AS BIGINT)"
    " AS n_not_finite FROM p2"))
def s5_prediction_report(spark, sf):
    return panel_io.prediction_report(fx.orders_panel(spark, sf).select("id", "target"))


@query("s6_shape_report", with_p1("SELECT count(*) AS n_rows, CAST(9 AS BIGINT) AS n_columns FROM p1"))
def s6_shape_report(spark, sf):
    return panel_io.shape_report(fx.hourly_events_panel(spark, sf))


# -- P ------------------------------------------------------------------------

@query("p1_project", with_p2("SELECT id, market, target FROM p2"))
def p1_project(spark, sf):
    return rel.project(fx.orders_panel(spark, sf), ["id", "market", "target"])


@query("p2_drop_columns", with_p2(f"SELECT id, {', '.join(P2F)} FROM p2"))
def p2_drop_columns(spark, sf):
    return rel.drop_if_present(fx.orders_panel(spark, sf), DROP_COLS + ["not_a_column"])


@query("p4_dropna_target", with_p1("SELECT * FROM p1 WHERE target IS NOT NULL"))
def p4_dropna_target(spark, sf):
    return rel.drop_null_rows(fx.hourly_events_panel(spark, sf), ["target"])


@query("p5_dropna_any", with_p2("SELECT * FROM p2 WHERE " + " AND ".join(
    f"{c} IS NOT NULL" for c in ["id", "market", "delivery_start", "delivery_end", "target", *P2F])))
def p5_dropna_any(spark, sf):
    return rel.drop_null_rows(fx.orders_panel(spark, sf))


@query("p6_filter_market", with_p2("SELECT * FROM p2 WHERE market = '1-URGENT'"))
def p6_filter_market(spark, sf):
    return rel.filter_market(fx.orders_panel(spark, sf), P2, "1-URGENT")


@query("p7_scoring_rows", with_p1("SELECT * FROM p1 WHERE target IS NULL"))
def p7_scoring_rows(spark, sf):
    return rel.split_labelled(fx.hourly_events_panel(spark, sf), P1)[1]


_P8_COLS = P2F + ["surface_pressure"]


@query("p8_fill_zero", with_p2(
    "SELECT id, market, delivery_start, delivery_end, "
    + ", ".join(f"coalesce({c}, 0.0) AS {c}" for c in P2F)
    + ", CAST(0.0 AS DOUBLE) AS surface_pressure FROM p2_test"))
def p8_fill_zero(spark, sf):
    _, test = fx.orders_train_test(spark, sf)
    return rel.fill_zero(test, _P8_COLS)


@query("p10_temporal_split", with_p2(
    "SELECT id, market, CASE WHEN delivery_start < cut THEN 'train' ELSE 'val' END AS split FROM p2,"
    " (SELECT max(delivery_start) - INTERVAL 3 MONTH AS cut FROM p2) c"))
def p10_temporal_split(spark, sf):
    tr, va = rel.temporal_split(fx.orders_panel(spark, sf), P2, val_months=3)
    return rel.stack([tr.select("id", "market", F.lit("train").alias("split")),
                      va.select("id", "market", F.lit("val").alias("split"))])


# -- I ------------------------------------------------------------------------

def _ffill_sql(c):
    return (f"CASE WHEN market IS NOT NULL THEN coalesce("
            f"last_value({c} IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
            f"first_value({c} IGNORE NULLS) OVER ({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) END AS {c}")


@query("i1_ffill_bfill", with_p1(
    "SELECT id, market, delivery_start, delivery_end, target, "
    + ", ".join(_ffill_sql(c) for c in P1F) + " FROM p1"))
def i1_ffill_bfill(spark, sf):
    return impute.impute_missing(fx.hourly_events_panel(spark, sf), P1, "ffill")


@query("i2_median_fill", with_p1(
    "SELECT p1.id, p1.market, p1.delivery_start, p1.delivery_end, p1.target, "
    + ", ".join(f"coalesce(p1.{c}, m.{c}) AS {c}" for c in P1F)
    + " FROM p1 LEFT JOIN (SELECT market, " + ", ".join(f"median({c}) AS {c}" for c in P1F)
    + " FROM p1 GROUP BY market) m ON p1.market = m.market"))
def i2_median_fill(spark, sf):
    return impute.impute_missing(fx.hourly_events_panel(spark, sf), P1, "median")


_P1_ALL = ["id", "market", "delivery_start", "delivery_end", "target", *P1F]


@query("i4_null_counts", with_p1(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM p1" for c in _P1_ALL)))
def i4_null_counts(spark, sf):
    return impute.null_counts(fx.hourly_events_panel(spark, sf))


# -- W ------------------------------------------------------------------------

@query("w1_target_lags", with_p1(
    "SELECT id, market, delivery_start, target, "
    + ", ".join(f"lag(target, {n}) OVER ({W}) AS target_lag_{n}h" for n in LAG_HOURS)
    + " FROM p1l", extra=P1L))
def w1_target_lags(spark, sf):
    df = windows.add_lag_features(_p1l(spark, sf), P1)
    return df.select("id", "market", "delivery_start", "target", *[f"target_lag_{n}h" for n in LAG_HOURS])


@query("w2_rolling_mean", with_p1(
    "SELECT id, market, "
    + ", ".join(f"avg(target) OVER ({W} ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING) AS target_roll_mean_{k}h"
                for k in ROLLING_WINDOWS) + " FROM p1l", extra=P1L))
def w2_rolling_mean(spark, sf):
    df = windows.add_rolling_features(_p1l(spark, sf), P1)
    return df.select("id", "market", *[f"target_roll_mean_{k}h" for k in ROLLING_WINDOWS])


@query("w3_rolling_std", with_p1(
    "SELECT id, market, "
    + ", ".join(rnd(f"stddev_samp(target) OVER ({W} ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)")
                + f" AS target_roll_std_{k}h" for k in ROLLING_WINDOWS) + " FROM p1l", extra=P1L))
def w3_rolling_std(spark, sf):
    df = windows.add_rolling_features(_p1l(spark, sf), P1)
    return df.select("id", "market", *[r4(f"target_roll_std_{k}h").alias(f"target_roll_std_{k}h")
                                       for k in ROLLING_WINDOWS])


@query("w4_weather_lags", with_p1(
    "SELECT id, market, "
    + ", ".join(f"lag(wind_speed_10m, {n}) OVER ({W}) AS wind_speed_10m_lag_{n}h" for n in LAG_HOURS)
    + " FROM p1"))
def w4_weather_lags(spark, sf):
    df = windows.add_weather_lags(fx.hourly_events_panel(spark, sf), P1)
    return df.select("id", "market", *[f"wind_speed_10m_lag_{n}h" for n in LAG_HOURS])


@query("w5_variable_lags", with_p2(
    "SELECT * FROM (SELECT *, lag(wind_forecast, 1) OVER ({W}) AS wind_forecast_lag_1h, "
    "lag(wind_forecast, 24) OVER ({W}) AS wind_forecast_lag_24h FROM p2) t WHERE ".format(W=W)
    + " AND ".join(f"{c} IS NOT NULL" for c in ["id", "market", "delivery_start", "delivery_end", "target",
                                                *P2F, "wind_forecast_lag_1h", "wind_forecast_lag_24h"])))
def w5_variable_lags(spark, sf):
    df = windows.add_variable_lags(fx.orders_panel(spark, sf), P2, {"wind_forecast": [1, 24]})
    return rel.drop_null_rows(df)


@query("w6_first_difference", with_p1(
    f"SELECT * FROM (SELECT id, market, target, target - lag(target, 1) OVER ({W}) AS target_diff FROM p1l) t"
    " WHERE target_diff IS NOT NULL", extra=P1L))
def w6_first_difference(spark, sf):
    return windows.first_difference(_p1l(spark, sf), P1, "target").select("id", "market", "target", "target_diff")


@query("w7_row_position", with_p2(
    "SELECT id, row_number() OVER (ORDER BY market, delivery_start, id) - 1 AS row_pos FROM p2"))
def w7_row_position(spark, sf):
    return windows.row_position(fx.orders_panel(spark, sf), P2, order="panel").select("id", "row_pos")


@query("w7_row_position_time", with_p2(
    "SELECT id, row_number() OVER (ORDER BY delivery_start, market, id) - 1 AS row_pos FROM p2"))
def w7_row_position_time(spark, sf):
    return windows.row_position(fx.orders_panel(spark, sf), P2, order="time").select("id", "row_pos")


# -- F ------------------------------------------------------------------------

_DOW = "(isodow(delivery_start) - 1)"


def _flag_sql(cond: str) -> str:
    return f"CAST(coalesce(CAST(({cond}) AS INTEGER), 0) AS INTEGER)"


@query("f1_temporal", with_p1(
    "SELECT id, CAST(hour(delivery_start) AS INTEGER) AS hour, CAST(" + _DOW + " AS INTEGER) AS day_of_week,"
    " CAST(month(delivery_start) AS INTEGER) AS month, " + _flag_sql(f"{_DOW} >= 5") + " AS is_weekend FROM p1"))
def f1_temporal(spark, sf):
    return feat.add_temporal_features(fx.hourly_events_panel(spark, sf), P1).select(
        "id", "hour", "day_of_week", "month", "is_weekend")


_F2_COLS = ([(f"hour_{h}", f"hour(delivery_start) = {h}") for h in range(24)]
            + [(f"day_{d}", f"{_DOW} = {d}") for d in range(7)]
            + [(f"month_{m}", f"month(delivery_start) = {m}") for m in range(1, 13)])


@query("f2_time_dummies", with_p2(
    "SELECT id, " + ", ".join(f"{_flag_sql(c)} AS {n}" for n, c in _F2_COLS) + " FROM p2"))
def f2_time_dummies(spark, sf):
    return feat.add_time_dummies(fx.orders_panel(spark, sf), P2).select("id", *[n for n, _ in _F2_COLS])


_F3_COLS = [(f"{m}_{h}h", f"month(delivery_start) = {mi} AND hour(delivery_start) = {h}")
            for mi, m in enumerate(MONTH_NAMES, start=1) for h in range(24) if not (mi == 1 and h == 0)]


@query("f3_month_hour_dummies", with_p1(
    "SELECT id, " + ", ".join(f"{_flag_sql(c)} AS {n}" for n, c in _F3_COLS) + " FROM p1"))
def f3_month_hour_dummies(spark, sf):
    return feat.add_month_hour_dummies(fx.hourly_events_panel(spark, sf), P1).select(
        "id", *[n for n, _ in _F3_COLS])


_PM = ", ".join(str(h) for h in PRIME_MORNING_HOURS)
_PN = ", ".join(str(h) for h in PRIME_NIGHT_HOURS)
_F4_COLS = ([(m, f"month(delivery_start) = {mi}") for mi, m in enumerate(MONTH_NAMES, start=1) if mi > 1]
            + [c for mi, m in enumerate(MONTH_NAMES, start=1) for c in (
                (f"{m}_PrimeMorning", f"month(delivery_start) = {mi} AND hour(delivery_start) IN ({_PM})"),
                (f"{m}_PrimeNight", f"month(delivery_start) = {mi} AND hour(delivery_start) IN ({_PN})"))])


@query("f4_prime_dummies", with_p1(
    "SELECT id, " + ", ".join(f"{_flag_sql(c)} AS {n}" for n, c in _F4_COLS) + " FROM p1"))
def f4_prime_dummies(spark, sf):
    return feat.add_time_prime_dummies(fx.hourly_events_panel(spark, sf), P1).select(
        "id", *[n for n, _ in _F4_COLS])


@query("f5_weekend_dummy", with_p2(
    "SELECT id, " + _flag_sql(f"{_DOW} IN (5, 6)") + " AS isWeekend FROM p2"))
def f5_weekend_dummy(spark, sf):
    return feat.add_weekend_dummy(fx.orders_panel(spark, sf), P2).select("id", "isWeekend")


_F6 = ["wind_speed_10m", "solar_forecast", "wind_forecast"]


@query("f6_squared", with_p2("SELECT id, " + ", ".join(f"{c} * {c} AS {c}_sq" for c in _F6) + " FROM p2"))
def f6_squared(spark, sf):
    return feat.add_squared_features(fx.orders_panel(spark, sf), _F6, missing="error").select(
        "id", *[f"{c}_sq" for c in _F6])


@query("f7_squared_skip", with_p2(
    "SELECT id, wind_forecast * wind_forecast AS wind_forecast_sq, "
    "wind_speed_10m * wind_speed_10m AS wind_speed_10m_sq FROM p2"))
def f7_squared_skip(spark, sf):
    from skein.spec import VAR_SQ
    df = feat.add_squared_features(fx.orders_panel(spark, sf), VAR_SQ, missing="skip")
    return df.select("id", *[c for c in df.columns if c.endswith("_sq")])


_F8 = [("load_forecast", "air_temperature_2m"), ("wind_forecast", "wind_speed_10m")]


@query("f8_interactions", with_p2("SELECT id, " + ", ".join(f"{a} * {b} AS {a}_x_{b}" for a, b in _F8) + " FROM p2"))
def f8_interactions(spark, sf):
    return feat.add_interaction_features(fx.orders_panel(spark, sf), _F8).select(
        "id", *[f"{a}_x_{b}" for a, b in _F8])


_F9_SQ = ["wind_speed_10m", "solar_forecast", "wind_forecast"]
_F9_IX = [("wind_forecast", "wind_speed_10m")]


def _f9_sql():
    cols = ["id", "market", "target", "CAST(hour(delivery_start) AS INTEGER) AS hour",
            f"CAST({_DOW} AS INTEGER) AS day_of_week", "CAST(month(delivery_start) AS INTEGER) AS month",
            _flag_sql(f"{_DOW} >= 5") + " AS is_weekend"]
    cols += [f"{c} * {c} AS {c}_sq" for c in _F9_SQ]
    cols += [f"{a} * {b} AS {a}_x_{b}" for a, b in _F9_IX]
    cols += [f"lag(wind_speed_10m, {n}) OVER ({W}) AS wind_speed_10m_lag_{n}h" for n in LAG_HOURS]
    cols += [f"lag(target, {n}) OVER ({W}) AS target_lag_{n}h" for n in LAG_HOURS]
    for k in ROLLING_WINDOWS:
        cols.append(f"avg(target) OVER ({W} ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING) AS target_roll_mean_{k}h")
        cols.append(rnd(f"stddev_samp(target) OVER ({W} ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)")
                    + f" AS target_roll_std_{k}h")
    imputed = ("p1i AS (SELECT id, market, delivery_start, delivery_end, target, "
               + ", ".join(_ffill_sql(c) for c in P1F) + " FROM p1), "
               "p1il AS (SELECT * FROM p1i WHERE target IS NOT NULL)")
    return with_p1("SELECT " + ", ".join(cols) + " FROM p1il", extra=imputed)


@query("f9_engineer_features", _f9_sql())
def f9_engineer_features(spark, sf):
    p = impute.impute_missing(fx.hourly_events_panel(spark, sf), P1, "ffill")
    p = rel.drop_null_rows(p, ["target"])
    df = feat.engineer_features(p, P1, squared=_F9_SQ, interactions=_F9_IX)
    std_cols = {f"target_roll_std_{k}h" for k in ROLLING_WINDOWS}
    keep = [c for c in df.columns if c not in ("delivery_start", "delivery_end", *P1F)]
    return df.select(*[r4(c).alias(c) if c in std_cols else F.col(c) for c in keep])


#: Rows of a bucket in the queries below: markets of the hourly panel have up to 720 rows, so each spans several.
_SMALL_BUCKET = {"strategy": "bucketed", "bucket_rows": 200}


@query("i1_ffill_bfill_bucketed", ORACLE["i1_ffill_bfill"])
def i1_ffill_bfill_bucketed(spark, sf):
    return windows.fill_forward_backward(fx.hourly_events_panel(spark, sf), P1, **_SMALL_BUCKET)


@query("w1_target_lags_bucketed", ORACLE["w1_target_lags"])
def w1_target_lags_bucketed(spark, sf):
    df = windows.add_lag_features(_p1l(spark, sf), P1, **_SMALL_BUCKET)
    return df.select("id", "market", "delivery_start", "target", *[f"target_lag_{n}h" for n in LAG_HOURS])


@query("w2_rolling_mean_bucketed", ORACLE["w2_rolling_mean"])
def w2_rolling_mean_bucketed(spark, sf):
    df = windows.add_rolling_features(_p1l(spark, sf), P1, **_SMALL_BUCKET)
    return df.select("id", "market", *[f"target_roll_mean_{k}h" for k in ROLLING_WINDOWS])


@query("w3_rolling_std_bucketed", ORACLE["w3_rolling_std"])
def w3_rolling_std_bucketed(spark, sf):
    df = windows.add_rolling_features(_p1l(spark, sf), P1, **_SMALL_BUCKET)
    return df.select("id", "market", *[r4(f"target_roll_std_{k}h").alias(f"target_roll_std_{k}h") for k in ROLLING_WINDOWS])


@query("w4_weather_lags_bucketed", ORACLE["w4_weather_lags"])
def w4_weather_lags_bucketed(spark, sf):
    df = windows.add_weather_lags(fx.hourly_events_panel(spark, sf), P1, **_SMALL_BUCKET)
    return df.select("id", "market", *[f"wind_speed_10m_lag_{n}h" for n in LAG_HOURS])


@query("w5_variable_lags_bucketed", ORACLE["w5_variable_lags"])
def w5_variable_lags_bucketed(spark, sf):
    return rel.drop_null_rows(windows.add_variable_lags(fx.orders_panel(spark, sf), P2, {"wind_forecast": [1, 24]}, **_SMALL_BUCKET))


@query("f9_engineer_features_bucketed", ORACLE["f9_engineer_features"])
def f9_engineer_features_bucketed(spark, sf):
    p = rel.drop_null_rows(windows.fill_forward_backward(fx.hourly_events_panel(spark, sf), P1, **_SMALL_BUCKET), ["target"])
    df = feat.engineer_features(p, P1, squared=_F9_SQ, interactions=_F9_IX, **_SMALL_BUCKET)
    std_cols = {f"target_roll_std_{k}h" for k in ROLLING_WINDOWS}
    keep = [c for c in df.columns if c not in ("delivery_start", "delivery_end", *P1F)]
    return df.select(*[r4(c).alias(c) if c in std_cols else F.col(c) for c in keep])


@query("f10_clip", with_p1(
    "SELECT id, CASE WHEN wind_speed_10m IS NOT NULL THEN least(greatest(wind_speed_10m, -100.0), 200.0) END"
    " AS wind_speed_10m_clipped, CASE WHEN target IS NOT NULL THEN least(greatest(target, -100.0), 200.0) END"
    " AS target_clipped FROM p1"))
def f10_clip(spark, sf):
    df = feat.add_clipped(fx.hourly_events_panel(spark, sf), "wind_speed_10m")
    df = feat.add_clipped(df, "target")
    return df.select("id", "wind_speed_10m_clipped", "target_clipped")


@query("f11_parse_times", with_p2("SELECT id, delivery_start, delivery_end FROM p2"))
def f11_parse_times(spark, sf):
    p = fx.orders_panel(spark, sf)
    text = p.select("id", F.date_format("delivery_start", "yyyy-MM-dd HH:mm:ss").alias("delivery_start"),
                    F.date_format("delivery_end", "yyyy-MM-dd HH:mm:ss").alias("delivery_end"))
    return panel_io.parse_times(text, ["delivery_start", "delivery_end"])


# -- E ------------------------------------------------------------------------

_MARKETS_P2 = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("e1_onehot_market", with_p2(
    "SELECT id, market, " + ", ".join(
        f"CAST(coalesce(CAST(market = '{v}' AS INTEGER), 0) AS INTEGER) AS \"market_{v}\"" for v in _MARKETS_P2)
    + " FROM p2_test"))
def e1_onehot_market(spark, sf):
    train, test = fx.orders_train_test(spark, sf)
    cats = encode.fit_categories(train, "market")
    df = encode.one_hot(test, "market", cats)
    return df.select("id", "market", *[c for c in df.columns if c.startswith("market_")])


@query("e2_label_market", with_p2(
    "SELECT id, CAST(CASE WHEN market IS NOT NULL THEN dense_rank() OVER (ORDER BY market) - 1 END AS INTEGER)"
    " AS market_label FROM p2"))
def e2_label_market(spark, sf):
    return encode.label_encode(fx.orders_panel(spark, sf), "market").select("id", "market_label")


@query("e4_standard_scaler", with_p2(
    "SELECT id, " + ", ".join(
        rnd(f"({c} - s.m_{c}) / (CASE WHEN s.s_{c} IS NULL OR s.s_{c} = 0 THEN 1.0 ELSE s.s_{c} END)") + f" AS {c}"
        for c in P2F)
    + " FROM p2_test, (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in P2F)
    + " FROM p2_train) s"))
def e4_standard_scaler(spark, sf):
    train, test = fx.orders_train_test(spark, sf)
    _, _, _, scaled = encode.scale_features(train, None, test, P2F)
    return scaled.select("id", *[r4(c).alias(c) for c in P2F])


# -- J / U / O ---------------------------------------------------------------

def _naive(spark, sf):
    """Two simple forecasts of P1: last value (lag 1) and 24-row rolling mean, keyed by id."""
    df = windows.window_features(_p1l(spark, sf), P1, lags={"target": [1]}, rolling={"target": [24]})
    return df


_NAIVE_SQL = (P1L + ", nv AS (SELECT id, market, target, lag(target, 1) OVER (" + W + ") AS lag1, "
              "avg(target) OVER (" + W + " ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS mean24 FROM p1l)")


@query("j1_attach_predictions", with_p1(
    "SELECT p1.*, nv.lag1 AS pred FROM p1 JOIN nv ON p1.id = nv.id", extra=_NAIVE_SQL))
def j1_attach_predictions(spark, sf):
    preds = _naive(spark, sf).select("id", F.col("target_lag_1h").alias("pred"))
    return rel.attach_predictions(fx.hourly_events_panel(spark, sf), preds)


@query("j2_align_predictions", with_p1(
    "SELECT coalesce(a.id, b.id) AS id, a.target AS a, b.target AS b, CASE WHEN a.id IS NOT NULL AND b.id IS NOT NULL"
    " THEN 'both' WHEN a.id IS NOT NULL THEN 'only_a' ELSE 'only_b' END AS side FROM"
    " (SELECT id, lag1 AS target FROM nv WHERE lag1 IS NOT NULL AND market <> 'click') a FULL OUTER JOIN"
    " (SELECT id, mean24 AS target FROM nv WHERE mean24 IS NOT NULL AND market <> 'view') b ON a.id = b.id",
    extra=_NAIVE_SQL))
def j2_align_predictions(spark, sf):
    nv = _naive(spark, sf)
    a = nv.where(F.col("target_lag_1h").isNotNull() & (F.col("market") != "click")).select(
        "id", F.col("target_lag_1h").alias("target"))
    b = nv.where(F.col("target_roll_mean_24h").isNotNull() & (F.col("market") != "view")).select(
        "id", F.col("target_roll_mean_24h").alias("target"))
    return rel.align_predictions(a, b)


@query("j4_ids_not_in", with_p2(
    "SELECT DISTINCT id FROM p2 WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = p2.id)"))
def j4_ids_not_in(spark, sf):
    with_lines = panel_io.load_table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"))
    return rel.ids_not_in(fx.orders_panel(spark, sf), with_lines)


@query("j5_complete_rows", with_p2("SELECT * FROM p2 WHERE target IS NOT NULL AND " + " AND ".join(
    f"{c} IS NOT NULL" for c in P2F)))
def j5_complete_rows(spark, sf):
    return rel.complete_rows(fx.orders_panel(spark, sf), ["target", *P2F])


@query("u1_stack", with_p2("SELECT * FROM p2_train UNION ALL BY NAME SELECT * FROM p2_test"))
def u1_stack(spark, sf):
    tr, te = fx.orders_train_test(spark, sf)
    return rel.stack([tr, te])


@query("u2_distinct_markets", with_p2("SELECT DISTINCT market FROM p2"))
def u2_distinct_markets(spark, sf):
    return rel.distinct_values(fx.orders_panel(spark, sf), "market")


@query("o1_sort_rows", with_p2("SELECT * FROM p2 ORDER BY market, delivery_start, id"))
def o1_sort_rows(spark, sf):
    return rel.sort_rows(fx.orders_panel(spark, sf), ["market", "delivery_start", "id"])


@query("o2_top_k", with_p2("SELECT * FROM p2 ORDER BY target DESC NULLS LAST, id LIMIT 10"))
def o2_top_k(spark, sf):
    return rel.top_k(fx.orders_panel(spark, sf), "target", 10, tie_col="id")


@query("o3_threshold", with_p2("SELECT * FROM p2 WHERE wind_forecast > 100.0"))
def o3_threshold(spark, sf):
    return rel.above(fx.orders_panel(spark, sf), "wind_forecast", 100.0)


@query("o4_seeded_sample", with_p2("SELECT * FROM p2 ORDER BY md5(CAST(id AS VARCHAR) || ':42'), id LIMIT 500"))
def o4_seeded_sample(spark, sf):
    return rel.seeded_sample(fx.orders_panel(spark, sf), 500, "id", seed=42)


# -- A ------------------------------------------------------------------------

@query("a1_summary", with_p1(
    "SELECT avg(target) AS mean, " + rnd("stddev_samp(target)") + " AS std, min(target) AS min, max(target) AS max"
    " FROM p1l", extra=P1L))
def a1_summary(spark, sf):
    s = stats.summary(_p1l(spark, sf), "target", ddof=1)
    return s.select("mean", r4("std").alias("std"), "min", "max")


@query("a2_count_range_by_market", with_p2(
    "SELECT market, count(*) AS n_rows, min(target) AS min, max(target) AS max FROM p2"
    " WHERE market IS NOT NULL GROUP BY market"))
def a2_count_range_by_market(spark, sf):
    return stats.count_range_by_market(fx.orders_panel(spark, sf), P2)


@query("a3_time_span", with_p2("SELECT min(delivery_start) AS first_time, max(delivery_start) AS last_time FROM p2"))
def a3_time_span(spark, sf):
    return stats.time_span(fx.orders_panel(spark, sf), P2)


_A4 = ["target", *P2F]


@query("a4_describe", with_p2(
    "SELECT column_name, count(value) AS count, avg(value) AS mean, " + rnd("stddev_samp(value)") + " AS std,"
    " min(value) AS min, quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50,"
    " quantile_cont(value, 0.75) AS p75, max(value) AS max FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS column_name, {c} AS value FROM p2 WHERE {c} IS NOT NULL" for c in _A4)
    + ") GROUP BY column_name"))
def a4_describe(spark, sf):
    d = stats.describe(fx.orders_panel(spark, sf), _A4)
    return d.select("column_name", "count", "mean", r4("std").alias("std"), "min", "p25", "p50", "p75", "max")


_P1_MARKETS = ["click", "error", "purchase", "signup", "view"]


@query("a5_hourly_pivot", with_p1(
    "SELECT CAST(hour(delivery_start) AS INTEGER) AS hour, "
    + ", ".join(f"avg(CASE WHEN market = '{m}' THEN target END) AS {m}" for m in _P1_MARKETS)
    + " FROM p1l GROUP BY 1", extra=P1L))
def a5_hourly_pivot(spark, sf):
    return stats.mean_pivot(_p1l(spark, sf), P1, by="hour")


@query("a5_monthly_pivot", with_p2(
    "SELECT CAST(month(delivery_start) AS INTEGER) AS month, "
    + ", ".join(f"avg(CASE WHEN market = '{m}' THEN target END) AS \"{m}\"" for m in _MARKETS_P2)
    + " FROM p2 WHERE market IS NOT NULL AND target IS NOT NULL GROUP BY 1"))
def a5_monthly_pivot(spark, sf):
    return stats.mean_pivot(fx.orders_panel(spark, sf), P2, by="month")


@query("a5_mean_profile", with_p2(
    "SELECT market, CAST(month(delivery_start) AS INTEGER) AS month, avg(target) AS mean, count(*) AS n"
    " FROM p2 WHERE market IS NOT NULL AND target IS NOT NULL GROUP BY 1, 2"))
def a5_mean_profile(spark, sf):
    return stats.mean_profile(fx.orders_panel(spark, sf), P2, by="month")


def _hist_sql(src: str, expr: str) -> str:
    return (
        f"b AS (SELECT min(v) AS lo0, max(v) AS hi0 FROM (SELECT {expr} AS v FROM {src} WHERE target IS NOT NULL)),"
        " bb AS (SELECT CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo,"
        " CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM b),"
        f" c AS (SELECT CAST(least(floor((v - lo) * 100.0 / (hi - lo)), 99) AS BIGINT) AS bin, count(*) AS n"
        f" FROM (SELECT {expr} AS v FROM {src} WHERE target IS NOT NULL), bb GROUP BY 1),"
        " e AS (SELECT CAST(r AS BIGINT) AS bin, lo + r * (hi - lo) / 100.0 AS lo, lo + (r + 1) * (hi - lo) / 100.0 AS hi"
        " FROM bb, range(100) t(r))")


@query("a6_histogram", with_p1(
    "SELECT e.bin, e.lo, e.hi, coalesce(c.n, 0) AS count FROM e LEFT JOIN c ON e.bin = c.bin",
    extra=P1L + ", " + _hist_sql("p1l", "target")))
def a6_histogram(spark, sf):
    return stats.histogram(_p1l(spark, sf), "target", 100)


@query("a6_histogram_clipped", with_p1(
    "SELECT e.bin, e.lo, e.hi, coalesce(c.n, 0) AS count FROM e LEFT JOIN c ON e.bin = c.bin",
    extra=P1L + ", " + _hist_sql("p1l", "least(greatest(target / 100.0, -100.0), 200.0)")))
def a6_histogram_clipped(spark, sf):
    df = _p1l(spark, sf).select((F.col("target") / 100.0).alias("price"))
    df = feat.add_clipped(df, "price", -100.0, 200.0, name="clipped")
    return stats.histogram(df, "clipped", 100)


@query("a7_box_stats", with_p2(
    "SELECT q.market, q.q1, q.median, q.q3, min(CASE WHEN p2.target >= q.q1 - 1.5 * (q.q3 - q.q1) THEN p2.target END)"
    " AS whisker_lo, max(CASE WHEN p2.target <= q.q3 + 1.5 * (q.q3 - q.q1) THEN p2.target END) AS whisker_hi"
    " FROM p2 JOIN q ON p2.market = q.market GROUP BY q.market, q.q1, q.median, q.q3",
    extra="q AS (SELECT market, quantile_cont(target, 0.25) AS q1, quantile_cont(target, 0.5) AS median,"
    " quantile_cont(target, 0.75) AS q3 FROM p2 WHERE market IS NOT NULL AND target IS NOT NULL GROUP BY market)"))
def a7_box_stats(spark, sf):
    return stats.box_stats(fx.orders_panel(spark, sf), P2)


@query("a8_median", with_p1("SELECT median(target) AS median FROM p1l", extra=P1L))
def a8_median(spark, sf):
    return stats.median(_p1l(spark, sf), "target")


_A9 = ["target", *P2F]


def _corr_sql():
    parts = []
    for a in _A9:
        for b in _A9:
            if a == b:
                v = f"CASE WHEN stddev_pop({a}) > 0 THEN 1.0 END"
            else:
                v = rnd(f"CASE WHEN isnan(corr({a}, {b})) THEN NULL ELSE corr({a}, {b}) END")
            parts.append(f"SELECT '{a}' AS f1, '{b}' AS f2, {v} AS corr FROM p2")
    return with_p2(" UNION ALL ".join(parts))


@query("a9_correlation", _corr_sql())
def a9_correlation(spark, sf):
    c = stats.corr_long(fx.orders_panel(spark, sf), _A9)
    return c.select("f1", "f2", r4("corr").alias("corr"))


@query("a10_daily_series", with_p1(
    "SELECT market, date_trunc('day', delivery_start) AS period, avg(target) AS mean, min(target) AS min,"
    " max(target) AS max, count(*) AS n_rows FROM p1l GROUP BY 1, 2", extra=P1L))
def a10_daily_series(spark, sf):
    return stats.daily_series(_p1l(spark, sf), P1)


# -- M / N --------------------------------------------------------------------

_NV_SCORED = _NAIVE_SQL + ", sc AS (SELECT * FROM nv WHERE lag1 IS NOT NULL)"


def _scored(spark, sf):
    nv = _naive(spark, sf)
    return nv.where(F.col("target_lag_1h").isNotNull()).withColumnRenamed("target_lag_1h", "pred")


def _metric_sql(group: bool) -> str:
    y, p = "target", "lag1"
    n = "count(target - lag1)"
    sst = f"(var_pop({y}) * {n})"
    sse = f"sum(({y} - {p}) * ({y} - {p}))"
    r2 = (f"CASE WHEN {n} < 2 THEN NULL WHEN {sst} = 0 THEN (CASE WHEN {sse} = 0 THEN 1.0 ELSE 0.0 END)"
          f" ELSE 1 - {sse} / {sst} END")
    cols = (f"avg(abs({y} - {p})) AS mae, sqrt(avg(({y} - {p}) * ({y} - {p}))) AS rmse, "
            + rnd(f"avg(abs({y} - {p}) / (abs({y}) + 1e-8)) * 100") + " AS mape, " + rnd(r2) + f" AS r2, {n} AS n_rows, "
            f"count(*) FILTER (WHERE {y} IS NULL OR {p} IS NULL) AS n_null")
    if group:
        return with_p1(f"SELECT market, {cols} FROM sc GROUP BY market", extra=_NV_SCORED)
    return with_p1(f"SELECT {cols} FROM sc", extra=_NV_SCORED)


def _round_metrics(df):
    return df.select(*[r4(c).alias(c) if c in ("mape", "r2") else F.col(c) for c in df.columns])


@query("m1_mae", with_p1("SELECT avg(abs(target - lag1)) AS mae FROM sc", extra=_NV_SCORED))
def m1_mae(spark, sf):
    return evaluate.mae(_scored(spark, sf))


@query("m2_rmse", with_p1("SELECT sqrt(avg((target - lag1) * (target - lag1))) AS rmse FROM sc", extra=_NV_SCORED))
def m2_rmse(spark, sf):
    return evaluate.rmse(_scored(spark, sf))


@query("m3_mape", with_p1("SELECT " + rnd("avg(abs(target - lag1) / (abs(target) + 1e-8)) * 100") + " AS mape FROM sc",
                          extra=_NV_SCORED))
def m3_mape(spark, sf):
    return evaluate.mape(_scored(spark, sf)).select(r4("mape").alias("mape"))


@query("m4_r2", with_p1(
    "SELECT " + rnd("1 - sum((target - lag1) * (target - lag1)) / (var_pop(target) * count(*))") + " AS r2 FROM sc",
    extra=_NV_SCORED))
def m4_r2(spark, sf):
    return evaluate.r2(_scored(spark, sf)).select(r4("r2").alias("r2"))


@query("m5_metrics", _metric_sql(False))
def m5_metrics(spark, sf):
    return _round_metrics(evaluate.metrics(_scored(spark, sf)))


@query("m6_metrics_by_market", _metric_sql(True))
def m6_metrics_by_market(spark, sf):
    return _round_metrics(evaluate.metrics_by_market(_scored(spark, sf)))


_ENS_SQL = (_NAIVE_SQL + ", ab AS (SELECT id, target, lag1 AS a, mean24 AS b FROM nv"
            " WHERE lag1 IS NOT NULL AND mean24 IS NOT NULL),"
            " w AS (SELECT avg(abs(target - a)) AS mae_a, avg(abs(target - b)) AS mae_b FROM ab)")


def _two_forecasts(spark, sf):
    nv = _naive(spark, sf).where(F.col("target_lag_1h").isNotNull() & F.col("target_roll_mean_24h").isNotNull())
    a = nv.select("id", F.col("target_lag_1h").alias("target"))
    b = nv.select("id", F.col("target_roll_mean_24h").alias("target"))
    scored = {"a": nv.select("target", F.col("target_lag_1h").alias("pred")),
              "b": nv.select("target", F.col("target_roll_mean_24h").alias("pred"))}
    return {"a": a, "b": b}, scored


@query("n1_mean_ensemble", with_p1("SELECT id, (a + b) / 2.0 AS target FROM ab", extra=_ENS_SQL))
def n1_mean_ensemble(spark, sf):
    preds, _ = _two_forecasts(spark, sf)
    return ensemble.mean_ensemble(preds)


@query("n2_inverse_mae_ensemble", with_p1(
    "SELECT id, " + rnd("((1.0 / mae_a) / (1.0 / mae_a + 1.0 / mae_b)) * a + ((1.0 / mae_b) / (1.0 / mae_a + 1.0 / mae_b)) * b")
    + " AS target FROM ab, w", extra=_ENS_SQL))
def n2_inverse_mae_ensemble(spark, sf):
    preds, scored = _two_forecasts(spark, sf)
    out = ensemble.inverse_mae_ensemble(preds, ensemble.mae_table(scored))
    return out.select("id", r4("target").alias("target"))
