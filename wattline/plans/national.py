"""The national feature table: from three raw series to features; building it runs the jobs that plan its chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wattline.functions.columns import nan_to_null
from wattline.functions.reference import DAY_PERIODS, LAGS, MAX_FILL_GAP, SETTLEMENT_STEP, WEEK_PERIODS
from wattline.operators.features import add_calendar, add_penetration, join_weather
from wattline.operators.gaps import align, joint_span
from wattline.operators.windows import add_windows

ROLLED = ["wind_pct", "solar_pct", "carbon_intensity"]
LAGGED = ["carbon_intensity", "wind_pct"]


def aligned_national(carbon: DataFrame, generation: DataFrame, step: str = SETTLEMENT_STEP, max_gap: int = MAX_FILL_GAP):
    """Aligned series with shares; intensity_actual is named carbon_intensity from here on."""
    aligned = align(nan_to_null(carbon), nan_to_null(generation), step=step, max_gap=max_gap)
    return add_penetration(aligned.withColumnRenamed("intensity_actual", "carbon_intensity"))


def national_features(
    carbon: DataFrame,
    generation: DataFrame,
    weather: DataFrame | None = None,
    step: str = SETTLEMENT_STEP,
    max_gap: int = MAX_FILL_GAP,
    window_rows: int = WEEK_PERIODS,
    min_periods: int = DAY_PERIODS,
    lags: list[int] = LAGS,
    entities: list[str] | None = None,
) -> DataFrame:
    """Align, shares, rolling means, lags, calendar, weather; rows null outside lags are dropped.

    Windows run before the weather join: they do not need it, and the row counts that plan
    their chunks then do not depend on it.
    """
    df = aligned_national(carbon, generation, step, max_gap)
    df = add_windows(
        df,
        "settlement_period",
        means={f"{c}_7d_avg": c for c in ROLLED if c in df.columns},
        lags={f"{c}_lag_{n}": (c, n) for c in LAGGED if c in df.columns for n in lags},
        window_rows=window_rows,
        min_periods=min_periods,
    )
    if weather is not None:
        cover = joint_span([carbon, generation], "settlement_period")
        df = join_weather(df, nan_to_null(weather), entities=entities, cover=cover)
    df = add_calendar(df)
    return df.dropna(subset=[c for c in df.columns if "_lag_" not in c])
