import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tests.helpers import UTC, period
from wattline.functions.columns import above, nan_to_null, right_closed_band, safe_name, slug, trim_strings
from wattline.functions.reference import easter_sunday, uk_holidays
from wattline.operators.features import add_calendar, add_penetration
from wattline.plans.medallion import gold_carbon, real_regions, silver_carbon, silver_weather
from wattline.plans.national import national_features


def at(spark, *days):
    rows = [(dt.datetime.fromisoformat(d).replace(tzinfo=UTC),) for d in days]
    return spark.createDataFrame(rows, "settlement_period timestamp")


def test_calendar_known_days(spark):
    got = add_calendar(at(spark, "2025-12-25T10:30", "2024-01-01T00:00", "2025-06-14T23:30"))
    xmas, new_year, saturday = (
        got.filter(F.col("settlement_period") == F.lit(d).cast("timestamp")).first()
        for d in ("2025-12-25 10:30:00", "2024-01-01 00:00:00", "2025-06-14 23:30:00")
    )
    assert xmas["is_bank_holiday_uk"] and not xmas["is_weekend"] and xmas["hour_of_day"] == 10
    assert new_year["is_bank_holiday_uk"] and new_year["day_of_week"] == 0 and new_year["day_of_year"] == 1
    assert saturday["is_weekend"] and not saturday["is_bank_holiday_uk"] and saturday["day_of_week"] == 5
    assert saturday["season_sin"] == pytest.approx(math.sin(2 * math.pi * 165 / 365))


def test_holiday_rules():
    assert [easter_sunday(y) for y in (1954, 1981, 2000, 2024, 2025, 2049)] == [
        dt.date(1954, 4, 18), dt.date(1981, 4, 19), dt.date(2000, 4, 23), dt.date(2024, 3, 31), dt.date(2025, 4, 20),
        dt.date(2049, 4, 18),
    ]
    assert dt.date(2022, 1, 3) in uk_holidays(2022)  # 1 January was a Saturday
    assert {dt.date(2021, 12, 27), dt.date(2021, 12, 28)} <= uk_holidays(2021)
    assert dt.date(2022, 12, 27) in uk_holidays(2022)
    assert dt.date(2020, 5, 8) in uk_holidays(2020) and dt.date(2020, 5, 4) not in uk_holidays(2020)
    assert dt.date(2025, 4, 20) not in uk_holidays(2025, include_easter_sunday=False)


def test_penetration(spark):
    df = spark.createDataFrame([(50.0, 30.0, 20.0, None), (0.0, 0.0, 0.0, 0.0)], "gas double, wind double, solar double, coal double")
    full, zero = add_penetration(df).collect()
    assert (full["wind_pct"], full["solar_pct"], full["low_carbon_pct"]) == (30.0, 20.0, 50.0)
    assert zero["wind_pct"] is None
    plain = spark.createDataFrame([(1,)], "x int")
    assert add_penetration(plain).columns == ["x"]
    assert "wind_pct" not in add_penetration(df.drop("wind")).columns


def test_national_features_row_counts(spark):
    n = 400
    carbon = spark.createDataFrame([(period(i), 200, 205) for i in range(n)],
                                   "settlement_period timestamp, intensity_actual int, intensity_forecast int")
    mix = spark.createDataFrame([(period(i), 30.0, 50.0, 20.0) for i in range(n)],
                                "settlement_period timestamp, wind double, gas double, solar double")
    weather = spark.createDataFrame(
        [(c, period(2 * h), 10.0, 5.0, 0.0) for c in ("London", "Manchester", "Edinburgh") for h in range(201)],
        "city string, timestamp timestamp, temperature double, wind_speed double, radiation double",
    )
    got = national_features(carbon, mix, weather).orderBy("settlement_period").toPandas()
    assert len(got) == 353
    assert got["carbon_intensity_lag_336"].isna().sum() == 289
    assert got.drop(columns=[c for c in got if "_lag_" in c]).notna().all().all()


def test_silver_and_gold(spark):
    rows = [(period(i), period(i + 1), 1, " A ", " Region ", -1 if i == 0 else i, "low ") for i in range(50)]
    rows.append((period(0), period(1), 15, "x", "GB", 5, "low"))
    bronze = spark.createDataFrame(
        rows, "period_from timestamp, period_to timestamp, region_id long, dno_region_name string, region_name string, "
        "carbon_intensity long, intensity_index string")
    silver = silver_carbon(real_regions(bronze))
    first = silver.orderBy("settlement_period").first()
    assert silver.count() == 50 and "period_to" not in silver.columns
    assert first["region_name"] == "Region" and first["carbon_intensity_valid"] is False and first["contains_nulls"] is False
    gold = gold_carbon(silver).orderBy("settlement_period").collect()
    assert gold[2]["rolling_avg_7day"] == pytest.approx((-1 + 1 + 2) / 3) and gold[49]["lag_48"] == 1


def test_silver_weather_flags(spark):
    rows = [(1, "R", period(0), -20.0, 10.0, None), (1, "R", period(2), 5.0, 90.0, 10.0)]
    got = silver_weather(spark.createDataFrame(
        rows, "region_id long, region_name string, timestamp timestamp, temperature double, wind_speed double, radiation double"
    )).orderBy("timestamp").collect()
    assert len(got) == 3
    assert (got[1]["temp_valid"], got[1]["wind_valid"], got[1]["rad_valid"], got[1]["has_nulls"]) == (False, True, None, True)
    assert got[2]["wind_valid"] is False


def test_column_helpers(spark):
    df = spark.createDataFrame([(float("nan"), " a ", 2.1), (1.0, "B c!", 5.6)], "x double, s string, y double")
    got = trim_strings(nan_to_null(df)).select(
        "*", above("x", 0.5).alias("hi"), right_closed_band("y", [0.0, 2.1, 5.5], ["L", "M", "H"]).alias("band"),
        safe_name(F.col("s")).alias("safe"),
    ).collect()
    assert got[0]["x"] is None and got[0]["s"] == "a" and got[0]["hi"] is False and got[1]["hi"] is True
    assert [r["band"] for r in got] == ["L", "H"] and got[1]["safe"] == "b_c_"
    assert slug("New Town") == "new_town"
