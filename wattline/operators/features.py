"""Feature composites: generation shares, calendar columns, wide weather."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.functions.columns import row_sum, slug
from wattline.functions.reference import FUELS, LOW_CARBON_FUELS, WEATHER_VARS, holiday_dimension
from wattline.operators.gaps import interpolate_onto


def add_penetration(df: DataFrame) -> DataFrame:
    """wind_pct, solar_pct, low_carbon_pct of the fuels present; a zero total gives null."""
    fuels = [c for c in FUELS if c in df.columns]
    if not fuels:
        return df
    total = row_sum(fuels)
    low_carbon = [c for c in LOW_CARBON_FUELS if c in df.columns]
    shares = {f"{c}_pct": F.try_divide(F.col(c).cast("double"), total) * 100 for c in ("wind", "solar") if c in df.columns}
    low_total = row_sum(low_carbon) if low_carbon else F.lit(0.0)
    return df.withColumns({**shares, "low_carbon_pct": F.try_divide(low_total, total) * 100})


def add_calendar(df: DataFrame, ts: str = "settlement_period", holidays: DataFrame | None = None) -> DataFrame:
    """Hour, weekday (Monday 0), day of year, month, weekend, season on the circle, UK holiday."""
    when = F.col(ts)
    turn = 2 * math.pi * F.dayofyear(when) / 365
    if holidays is None:
        holidays = holiday_dimension(df.sparkSession)
    named = df.withColumns(
        {
            "hour_of_day": F.hour(when),
            "day_of_week": F.weekday(when),
            "day_of_year": F.dayofyear(when),
            "month": F.month(when),
            "is_weekend": F.weekday(when) >= 5,
            "season_sin": F.sin(turn),
            "season_cos": F.cos(turn),
        }
    )
    dates = F.broadcast(holidays.select("holiday_date").distinct())
    joined = named.join(dates, F.to_date(ts) == F.col("holiday_date"), "left")
    return joined.withColumn("is_bank_holiday_uk", F.col("holiday_date").isNotNull()).drop("holiday_date")


def entity_names(df: DataFrame, entity: str) -> list[str]:
    """Distinct entities, which become columns; a wide table bounds their number."""
    found = df.select(entity).distinct().filter(F.col(entity).isNotNull()).limit(1001).collect()
    if len(found) > 1000:
        raise ValueError(f"more than 1000 values of {entity}: too many for one wide table")
    return sorted(row[0] for row in found)


def widen(
    df: DataFrame,
    entity: str,
    ts: str,
    variables: list[str] = WEATHER_VARS,
    entities: list[str] | None = None,
    keys: list[str] = (),
) -> DataFrame:
    """One row per time with a column ``{slug}_{variable}`` for each entity and variable."""
    names = entities if entities is not None else entity_names(df, entity)
    return df.groupBy(*keys, ts).agg(
        *[
            F.first(F.when(F.col(entity) == name, F.col(v)), ignorenulls=True).alias(f"{slug(name)}_{v}")
            for name in names
            for v in variables
        ]
    )


def join_weather(
    grid: DataFrame,
    weather: DataFrame,
    ts: str = "settlement_period",
    entity: str = "city",
    weather_ts: str = "timestamp",
    variables: list[str] = WEATHER_VARS,
    entities: list[str] | None = None,
    extrapolate: bool = True,
    cover: DataFrame | None = None,
) -> DataFrame:
    """``grid`` plus interpolated ``{slug}_{variable}`` columns.

    The weather is pivoted first, so every city is interpolated in one pass and the grid is not
    repeated per city.
    """
    missing = {entity, weather_ts, *variables} - set(weather.columns)
    if missing:
        raise ValueError(f"weather lacks columns: {sorted(missing)}")
    wide = widen(weather, entity, weather_ts, variables, entities).withColumnRenamed(weather_ts, ts)
    columns = [c for c in wide.columns if c != ts]
    return interpolate_onto(grid, wide, columns, ts, extrapolate=extrapolate, cover=cover)
