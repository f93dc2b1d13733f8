"""Panel specification and the fixed column lists of the forecasting task.

A panel is a table with one row per (market, time): an ``id`` that stays with
the row from input to prediction, a ``market`` key, a start/end timestamp, a
``target`` and numeric features. Every operator takes column names from a
``PanelSpec`` instead of hard-wiring them.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values of the task (names and defaults must equal the original task's).
# ---------------------------------------------------------------------------

NUMERIC_FEATURES = [
    "global_horizontal_irradiance",
    "diffuse_horizontal_irradiance",
    "direct_normal_irradiance",
    "cloud_cover_total",
    "cloud_cover_low",
    "cloud_cover_mid",
    "cloud_cover_high",
    "precipitation_amount",
    "visibility",
    "air_temperature_2m",
    "apparent_temperature_2m",
    "dew_point_temperature_2m",
    "wet_bulb_temperature_2m",
    "surface_pressure",
    "freezing_level_height",
    "relative_humidity_2m",
    "convective_available_potential_energy",
    "lifted_index",
    "convective_inhibition",
    "wind_speed_80m",
    "wind_direction_80m",
    "wind_gust_speed_10m",
    "wind_speed_10m",
    "solar_forecast",
    "wind_forecast",
    "load_forecast",
]

TARGET = "target"
MARKET = "market"
DELIVERY_START = "delivery_start"
DELIVERY_END = "delivery_end"
ID = "id"

# Default target lags, flow-B lags and rolling windows (rows, named in hours).
LAG_HOURS = [1, 2, 6, 12, 24, 48, 168]
ARX_LAG_HOURS = [1, 2, 3, 6, 12, 24, 48, 168]
ROLLING_WINDOWS = [6, 24, 168]

# Squared-feature defaults of the two feature modules.
SQUARED_COLS = [
    "wind_speed_10m",
    "wind_speed_80m",
    "wind_gust_speed_10m",
    "solar_forecast",
    "wind_forecast",
]
VAR_SQ = [
    "global_horizontal_irradiance",
    "wind_gust_speed_10m",
    "wind_speed_80m",
    "wind_forecast",
    "wind_speed_10m",
]

INTERACTIONS = [
    ("solar_forecast", "cloud_cover_total"),
    ("wind_forecast", "wind_speed_10m"),
    ("load_forecast", "air_temperature_2m"),
    ("solar_forecast", "global_horizontal_irradiance"),
    ("wind_forecast", "wind_speed_80m"),
]

WEATHER_LAGS = [
    "wind_speed_80m",
    "wind_speed_10m",
    "relative_humidity_2m",
    "global_horizontal_irradiance",
]

# Columns the flow-C regression drops before fitting (id is NOT dropped).
DROP_COLS = ["market", "target", "delivery_start", "delivery_end"]

# Flow-B feature lists.
EXOG_FEATURES = [
    "solar_forecast", "wind_forecast", "load_forecast",
    "air_temperature_2m", "wind_speed_10m", "wind_speed_80m",
    "cloud_cover_total", "surface_pressure",
    "hour", "day_of_week", "month", "is_weekend",
    "wind_speed_10m_sq", "wind_speed_80m_sq", "solar_forecast_sq",
    "solar_forecast_x_cloud_cover_total",
    "wind_forecast_x_wind_speed_10m",
    "load_forecast_x_air_temperature_2m",
]
AR_FEATURES = [
    "target_lag_1h", "target_lag_2h", "target_lag_3h",
    "target_lag_6h", "target_lag_12h", "target_lag_24h",
    "target_lag_48h", "target_lag_168h",
    "target_roll_mean_6h", "target_roll_mean_24h", "target_roll_mean_168h",
    "target_roll_std_6h", "target_roll_std_24h", "target_roll_std_168h",
]

MONTH_NAMES = ["JANUARY", "FEBRUARY", "MARCH", "APRIL", "MAY", "JUNE",
               "JULY", "AUGUST", "SEPTEMBER", "OCTOBER", "NOVEMBER", "DECEMBER"]
PRIME_MORNING_HOURS = [7, 8, 9]
PRIME_NIGHT_HOURS = [17, 18, 19]

# Default search grids.
SGD_GRID = {"alpha": [1e-5, 1e-4, 1e-3, 1e-2], "epsilon": [0.01, 0.05, 0.1, 0.5],
            "learning_rate": ["invscaling", "adaptive"], "eta0": [0.001, 0.01, 0.1]}
KERNEL_GRID = {"kernel": ["rbf", "linear"], "C": [1, 10, 100], "epsilon": [0.01, 0.1, 0.5], "gamma": ["scale", "auto"]}


@dataclass(frozen=True)
class PanelSpec:
    """Names of the key columns of a panel plus its numeric feature columns."""

    id: str = ID
    market: str = MARKET
    time: str = DELIVERY_START
    end: str = DELIVERY_END
    target: str = TARGET
    features: tuple[str, ...] = field(default_factory=lambda: tuple(NUMERIC_FEATURES))

    def with_features(self, features) -> "PanelSpec":
        return replace(self, features=tuple(features))

    @property
    def keys(self) -> list[str]:
        return [self.id, self.market, self.time, self.end]

    def window(self) -> Window:
        """Rows of one market in time order; ``id`` breaks ties so order is total."""
        return Window.partitionBy(self.market).orderBy(
            F.col(self.time).asc_nulls_last(), F.col(self.id).asc_nulls_last())

    def present(self, df: DataFrame, cols) -> list[str]:
        have = set(df.columns)
        return [c for c in cols if c in have]


def nan_to_null(c: Column) -> Column:
    """NaN is not a missing marker in Spark; fold it into NULL at the source."""
    return F.when(F.isnan(c), F.lit(None).cast(T.DoubleType())).otherwise(c)


def clean_numeric(df: DataFrame, cols) -> DataFrame:
    """Cast feature/target columns to double and turn NaN into NULL, in one projection."""
    want = set(cols)
    exprs = [
        nan_to_null(F.col(c).cast(T.DoubleType())).alias(c) if c in want else F.col(c)
        for c in df.columns
    ]
    return df.select(*exprs)


def panel_schema(spec: PanelSpec, with_target: bool = True) -> T.StructType:
    fields = [
        T.StructField(spec.id, T.LongType(), True),
        T.StructField(spec.market, T.StringType(), True),
        T.StructField(spec.time, T.TimestampNTZType(), True),
        T.StructField(spec.end, T.TimestampNTZType(), True),
    ]
    if with_target:
        fields.append(T.StructField(spec.target, T.DoubleType(), True))
    fields += [T.StructField(c, T.DoubleType(), True) for c in spec.features]
    return T.StructType(fields)
