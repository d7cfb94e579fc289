"""Fixed reference values and the small dimension tables built from them."""

from __future__ import annotations

import datetime as dt
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Fuels of the generation mix, and those counted as low carbon.
FUELS = ["gas", "coal", "nuclear", "wind", "hydro", "imports", "biomass", "other", "solar"]
LOW_CARBON_FUELS = ["nuclear", "wind", "hydro", "solar", "biomass"]

# Weather variables and their names in the archive payload.
WEATHER_VARS = ["temperature", "wind_speed", "radiation"]
WEATHER_PAYLOAD_FIELDS = {
    "temperature": "temperature_2m",
    "wind_speed": "wind_speed_10m",
    "radiation": "shortwave_radiation",
}

# Row offsets and windows on the half-hour grid.
LAGS = [1, 2, 48, 336]
WEEK_PERIODS = 336
DAY_PERIODS = 48
MAX_FILL_GAP = 3
SETTLEMENT_STEP = "30 minutes"

# Validation bounds (strict checks) and flag bounds (layer tables).
INTENSITY_BOUNDS = (0, 800)
WEATHER_CHECK_BOUNDS = {"temperature": (-30.0, 50.0), "wind_speed": (0.0, 150.0), "radiation": (0.0, None)}
WEATHER_FLAG_BOUNDS = {"temperature": (-15.0, 40.0), "wind_speed": (0.0, 75.0), "radiation": (0.0, 1100.0)}

# Quantiles and per-region loss bands.
ALPHAS = [0.1, 0.5, 0.9]
LOSS_BAND_EDGES = [0.0, 2.1, 5.5]
LOSS_BAND_LABELS = ["LOW", "MEDIUM", "HIGH"]

# Cities (name, latitude, longitude).
CITIES = [
    ("London", 51.5, -0.1),
    ("Manchester", 53.5, -2.2),
    ("Edinburgh", 55.9, -3.2),
]

# Distribution regions (id, name, latitude, longitude).
REGIONS = [
    (1, "North Scotland", 57.4778, -4.2247),
    (2, "South Scotland", 55.9533, -3.1883),
    (3, "North West England", 53.4808, -2.2426),
    (4, "North East England", 54.9783, -1.6178),
    (5, "Yorkshire", 53.8008, -1.5491),
    (6, "North Wales & Merseyside", 53.4084, -2.9916),
    (7, "South Wales", 51.4816, -3.1791),
    (8, "West Midlands", 52.4862, -1.8904),
    (9, "East Midlands", 52.9548, -1.1581),
    (10, "East England", 52.6309, 1.2974),
    (11, "South West England", 51.4545, -2.5879),
    (12, "South England", 50.9097, -1.4044),
    (13, "London", 51.5074, -0.1278),
    (14, "South East England", 50.8229, -0.1363),
]

# One-off UK holidays, and spring/May bank holidays that were moved.
ONE_OFF_HOLIDAYS = [
    "1973-11-14", "1977-06-07", "1981-07-29", "1999-12-31", "2002-06-03", "2011-04-29",
    "2012-06-05", "2022-06-03", "2022-09-19", "2023-05-08",
]
MOVED_EARLY_MAY = {1995: "1995-05-08", 2020: "2020-05-08"}
MOVED_SPRING = {1977: "1977-06-06", 2002: "2002-06-04", 2012: "2012-06-04", 2022: "2022-06-02"}


def region_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        REGIONS, "region_id long, region_name string, latitude double, longitude double"
    )


def city_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CITIES, "city string, latitude double, longitude double")


def easter_sunday(year: int) -> dt.date:
    """Gregorian Easter: the Sunday after the ecclesiastical full moon."""
    golden = year % 19
    century = year // 100
    moon_shift = (century - century // 4 - (8 * century + 13) // 25 + 19 * golden + 15) % 30
    if moon_shift > 28 or (moon_shift == 28 and golden > 10):
        moon_shift -= 1
    full_moon = dt.date(year, 3, 21) + dt.timedelta(days=moon_shift)
    return full_moon + dt.timedelta(days=(6 - full_moon.weekday()) or 7)


def _first_monday(year: int, month: int) -> dt.date:
    first = dt.date(year, month, 1)
    return first + dt.timedelta(days=(-first.weekday()) % 7)


def _last_monday(year: int, month: int) -> dt.date:
    last = dt.date(year, month, 31)
    return last - dt.timedelta(days=last.weekday())


def uk_holidays(year: int, include_easter_sunday: bool = True) -> set[dt.date]:
    """UK bank holidays of one year: fixed days, Easter days, Monday holidays, substitutes."""
    day = dt.timedelta(days=1)
    new_year, christmas = dt.date(year, 1, 1), dt.date(year, 12, 25)
    easter = easter_sunday(year)
    found = {new_year, christmas, christmas + day, easter - 2 * day, easter + day}
    if include_easter_sunday:
        found.add(easter)
    if new_year.weekday() >= 5:
        found.add(new_year + (7 - new_year.weekday()) * day)
    # A weekend Christmas or Boxing Day is replaced on the next free weekday(s).
    if christmas.weekday() in (5, 6):
        found.add(christmas + 2 * day)
    if (christmas + day).weekday() in (5, 6):
        found.add(christmas + 3 * day)
    moved_may, moved_spring = MOVED_EARLY_MAY.get(year), MOVED_SPRING.get(year)
    if year >= 1978:
        found.add(dt.date.fromisoformat(moved_may) if moved_may else _first_monday(year, 5))
    found.add(dt.date.fromisoformat(moved_spring) if moved_spring else _last_monday(year, 5))
    found.add(_last_monday(year, 8))
    found.update(d for d in map(dt.date.fromisoformat, ONE_OFF_HOLIDAYS) if d.year == year)
    return found


def holiday_dimension(
    spark: SparkSession, first_year: int = 1583, last_year: int = 9998, include_easter_sunday: bool = True
) -> DataFrame:
    """(holiday_date) of all years of the Gregorian calendar: about 75,000 dates, safe to broadcast."""
    days = _holidays(first_year, last_year, include_easter_sunday)
    return spark.createDataFrame(pa.table({"holiday_date": pa.array(days, pa.date32())}))


@lru_cache(maxsize=8)
def _holidays(first_year: int, last_year: int, include_easter_sunday: bool) -> tuple[dt.date, ...]:
    years = range(first_year, last_year + 1)
    return tuple(sorted(d for y in years for d in uk_holidays(y, include_easter_sunday)))
