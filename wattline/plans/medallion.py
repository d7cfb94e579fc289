"""Regional layers: raw (bronze), cleaned and flagged (silver), features (gold)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.functions.columns import any_null, in_range, nan_to_null, trim_strings
from wattline.functions.reference import LAGS, WEATHER_FLAG_BOUNDS, WEATHER_VARS, WEEK_PERIODS
from wattline.operators.gaps import upsample_last_row
from wattline.operators.windows import add_windows

REAL_REGIONS = 14
CARBON_KEYS = ["region_id", "settlement_period"]
WEATHER_FLAGS = {"wind_valid": "wind_speed", "temp_valid": "temperature", "rad_valid": "radiation"}


def real_regions(df: DataFrame) -> DataFrame:
    """The feed also carries national aggregates with higher ids."""
    return df.filter(F.col("region_id") <= REAL_REGIONS)


def silver_carbon(bronze: DataFrame) -> DataFrame:
    """Rename the period, trim text, flag negative values and nulls; nothing is filled."""
    renamed = bronze.withColumnRenamed("period_from", "settlement_period").drop("period_to")
    cleaned = trim_strings(renamed)
    return cleaned.withColumns(
        {
            "carbon_intensity_valid": in_range("carbon_intensity", low=0),
            "contains_nulls": any_null(renamed.columns),
        }
    )


def gold_carbon(silver: DataFrame, lags: list[int] = LAGS, window_rows: int = WEEK_PERIODS) -> DataFrame:
    """Seven-day mean (no minimum) and lags per region."""
    return add_windows(
        silver,
        "settlement_period",
        ["region_id"],
        means={"rolling_avg_7day": "carbon_intensity"},
        lags={f"lag_{n}": ("carbon_intensity", n) for n in lags},
        window_rows=window_rows,
    )


def silver_weather(bronze: DataFrame, bounds: dict = WEATHER_FLAG_BOUNDS) -> DataFrame:
    """Half-hourly by repeating the last row, then range flags and a null flag."""
    half_hourly = upsample_last_row(nan_to_null(bronze), "timestamp", ["region_id"])
    flags = {flag: in_range(column, *bounds[column]) for flag, column in WEATHER_FLAGS.items()}
    return half_hourly.withColumns({**flags, "has_nulls": any_null(WEATHER_VARS)})


def gold_carbon_weather(gold: DataFrame, weather: DataFrame, window_rows: int = WEEK_PERIODS) -> DataFrame:
    """Carbon features joined to the region's weather, plus the seven-day mean temperature."""
    plain = weather.withColumnRenamed("timestamp", "settlement_period").drop(
        *WEATHER_FLAGS, "has_nulls", "region_name"
    )
    joined = gold.join(plain, on=CARBON_KEYS, how="inner")
    return add_windows(
        joined, "settlement_period", ["region_id"], means={"temp_roll_avg_7day": "temperature"}, window_rows=window_rows
    )


def training_rows(gold: DataFrame, lags: list[int] = LAGS) -> DataFrame:
    """Rows past the lag warm-up."""
    return gold.dropna(subset=[f"lag_{n}" for n in lags])
