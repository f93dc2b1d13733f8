"""Panels built from the driver's tables (schema shaping only, no modelling work).

* P1 ``hourly_events_panel``: markets = event types, a regular hourly grid over the
  global span of the events, left-joined with hourly aggregates, so empty hours
  give real gaps.
* P2 ``orders_panel``: one row per order, irregular daily times with ties, features
  from per-order lineitem aggregates (orders without lines give nulls).
* ``lineitem_panel``: one row per line item for volume runs (order-free ops only).

Every numeric column is an integer-valued double, so sums and means are exact in
any summation order and the DuckDB oracle agrees bit for bit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.sources.panel_io import load_table
from skein.spec import PanelSpec

P1_FEATURES = ("load_forecast", "wind_forecast", "solar_forecast", "wind_speed_10m")
P2_FEATURES = ("load_forecast", "wind_forecast", "solar_forecast", "air_temperature_2m",
               "wind_speed_10m")
VOLUME_FEATURES = ("load_forecast", "wind_forecast", "solar_forecast", "air_temperature_2m",
                   "wind_speed_10m")

P1_SPEC = PanelSpec(features=P1_FEATURES)
P2_SPEC = PanelSpec(features=P2_FEATURES)
VOLUME_SPEC = PanelSpec(features=VOLUME_FEATURES)

P2_TEST_START = "2001-01-01 00:00:00"


def hourly_events_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_type x hour) grid over the global hour span, with hourly aggregates."""
    ev = load_table(spark, sf_dir, "events").select("ts", "user_id", "event_type", "value")
    hourly = (
        ev.where(F.col("ts").isNotNull())
        .groupBy(F.col("event_type").alias("market"),
                 F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("delivery_start"))
        .agg(
            F.sum(F.round(F.col("value") * 100)).alias("target"),
            F.count(F.lit(1)).cast("double").alias("load_forecast"),
            F.sum("user_id").cast("double").alias("wind_forecast"),
            F.round((F.max("value") - F.min("value")) * 100).alias("solar_forecast"),
            F.min("user_id").cast("double").alias("wind_speed_10m"),
        )
    )
    # Market table: one row per market (small); the span and ranks are windows over it.
    everything = Window.partitionBy()
    markets = (
        hourly.groupBy("market")
        .agg(F.min("delivery_start").alias("lo"), F.max("delivery_start").alias("hi"))
        .select(
            "market",
            (F.dense_rank().over(everything.orderBy("market")) - 1).alias("mrank"),
            F.count(F.lit(1)).over(everything).alias("n_markets"),
            F.min("lo").over(everything).alias("g_lo"),
            F.max("hi").over(everything).alias("g_hi"),
        )
    )
    grid = markets.select(
        "market", "mrank", "n_markets", "g_lo",
        F.explode(F.sequence("g_lo", "g_hi", F.expr("INTERVAL 1 HOUR"))).alias("delivery_start"),
    )
    # Wall-clock hours between NTZ values: no session time zone (and no DST shift) involved.
    hour_idx = F.timestamp_diff("HOUR", F.col("g_lo"), F.col("delivery_start")).cast("long")
    grid = grid.select(
        (F.col("n_markets") * hour_idx + F.col("mrank")).alias("id"),
        "market", "delivery_start",
        (F.col("delivery_start") + F.expr("INTERVAL 1 HOUR")).alias("delivery_end"),
    )
    return grid.join(hourly, ["market", "delivery_start"], "left").select(
        "id", "market", "delivery_start", "delivery_end", "target", *P1_FEATURES)


def orders_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with per-order lineitem aggregates (left join: orders without lines keep nulls)."""
    orders = load_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("market"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("delivery_start"),
        (F.col("o_orderdate").cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")).alias("delivery_end"),
        F.round(F.col("o_totalprice") * 100).alias("target"),
    )
    lines = (
        load_table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("id"))
        .agg(
            F.count(F.lit(1)).cast("double").alias("load_forecast"),
            F.sum("l_quantity").alias("wind_forecast"),
            F.sum(F.round(F.col("l_discount") * 100)).alias("solar_forecast"),
            F.sum(F.round(F.col("l_tax") * 100)).alias("air_temperature_2m"),
            F.max("l_linenumber").cast("double").alias("wind_speed_10m"),
        )
    )
    return orders.join(lines, "id", "left").select(
        "id", "market", "delivery_start", "delivery_end", "target", *P2_FEATURES)


def orders_train_test(spark: SparkSession, sf_dir: str):
    """P2 split: train before 2001-01-01, test from then on with the target hidden."""
    return split_orders(orders_panel(spark, sf_dir))


def split_orders(panel: DataFrame):
    """Train and test rows of an orders panel."""
    cut = F.lit(P2_TEST_START).cast("timestamp_ntz")
    train = panel.where(F.col("delivery_start") < cut)
    test = panel.where(F.col("delivery_start") >= cut).drop("target")
    return train, test


def lineitem_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volume panel: one row per line item, market = returnflag || linestatus."""
    li = load_table(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
        F.concat("l_returnflag", "l_linestatus").alias("market"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("delivery_start"),
        (F.col("l_shipdate").cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")).alias("delivery_end"),
        F.round(F.col("l_extendedprice") * 100).alias("target"),
        F.round(F.col("l_extendedprice") / F.col("l_quantity")).alias("load_forecast"),
        F.col("l_quantity").alias("wind_forecast"),
        F.round(F.col("l_discount") * 100).alias("solar_forecast"),
        F.round(F.col("l_tax") * 100).alias("air_temperature_2m"),
        F.col("l_linenumber").cast("double").alias("wind_speed_10m"),
    )
