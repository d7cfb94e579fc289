"""Grids, windows, gaps, joins, features, layers, summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import ALIGNED, CALENDAR_SQL, LAG_COLUMNS, ROLLED, WIDE, Tables, r, sql
from wattline.functions.columns import above, right_closed_band
from wattline.functions.reference import LOSS_BAND_EDGES, LOSS_BAND_LABELS, region_dimension
from wattline.operators import aggregates, gaps, windows
from wattline.operators.features import add_calendar, add_penetration, join_weather, widen
from wattline.plans import medallion, national
from wattline.sources import bindings

CITY_NAMES = ["London", "Manchester", "Edinburgh"]


def align_periods(t: Tables):
    return gaps.align(t.carbon, t.generation)


def _aligned(t: Tables):
    return national.aligned_national(t.carbon, t.generation)


def weather_interpolated(t: Tables):
    wide = widen(t.weather, "city", "timestamp", entities=CITY_NAMES).withColumnRenamed("timestamp", "settlement_period")
    grid = t.carbon.select("settlement_period")
    return gaps.interpolate_onto(grid, wide, [c for c in wide.columns if c != "settlement_period"], "settlement_period")


def weather_to_grid(t: Tables):
    return join_weather(gaps.align(t.carbon, t.generation), t.weather, entities=CITY_NAMES)


def penetration(t: Tables):
    return add_penetration(gaps.align(t.carbon, t.generation)).select(
        "settlement_period", "wind_pct", "solar_pct", "low_carbon_pct"
    )


def rolling_min_periods(t: Tables):
    df = windows.rolling_mean(_aligned(t), ROLLED, "settlement_period", min_periods=48)
    return df.select("settlement_period", *[f"{c}_7d_avg" for c in ROLLED])


def lag_features(t: Tables):
    df = windows.lag_columns(_aligned(t), ["carbon_intensity", "wind_pct"], "settlement_period")
    return df.select("settlement_period", *[f"{c}_lag_{n}" for c, n in LAG_COLUMNS])


def calendar_features(t: Tables):
    return add_calendar(gaps.align(t.carbon, t.generation).select("settlement_period"))


def national_features(t: Tables):
    return national.national_features(t.carbon, t.generation, t.weather, entities=CITY_NAMES)


def silver_regional(t: Tables):
    return medallion.silver_carbon(medallion.real_regions(t.regional_bronze))


def gold_regional(t: Tables):
    return medallion.gold_carbon(silver_regional(t))


def weather_half_hourly(t: Tables):
    return medallion.silver_weather(t.regional_weather)


def gold_carbon_weather(t: Tables):
    return medallion.gold_carbon_weather(gold_regional(t), weather_half_hourly(t))


def row_numbers(t: Tables):
    return windows.row_index(t.regional, "settlement_period", ["region_id"])


def duplicate_periods(t: Tables):
    """Periods in which a region has more than one event."""
    region = (F.col("user_id") % 14 + 1).cast("long").alias("region_id")
    raw = t.events.select(region, bindings.slot().alias("settlement_period"))
    return windows.duplicate_times(raw, "settlement_period", ["region_id"])


def profile(t: Tables):
    return aggregates.profile(t.regional, ["region_id", "carbon_intensity"])


def group_mean(t: Tables):
    return aggregates.group_mean(t.regional, ["region_id"], ["carbon_intensity"])


def region_counts(t: Tables):
    return aggregates.group_counts(t.regional, [], "region_id")


def region_extent(t: Tables):
    return aggregates.time_extent(t.regional, "settlement_period", ["region_id"])


def median_by_region(t: Tables):
    return aggregates.exact_percentile(t.regional, "carbon_intensity", 0.5, ["region_id"], "median_carbon")


def earliest_latest(t: Tables):
    """Earliest and latest five rows."""
    tie = [F.col("region_id")]
    first = aggregates.top_rows(t.regional, [F.col("settlement_period").asc(), *tie], 5).withColumn("side", F.lit("earliest"))
    last = aggregates.top_rows(t.regional, [F.col("settlement_period").desc(), *tie], 5).withColumn("side", F.lit("latest"))
    return first.unionByName(last)


def high_carbon(t: Tables):
    return t.regional.filter(F.col("carbon_intensity") > 200).withColumn("high_carbon", above("carbon_intensity", 250))


def loss_band(t: Tables):
    scaled = t.regional.withColumn("loss", F.col("carbon_intensity") / 100.0)
    return scaled.withColumn("band", right_closed_band("loss", LOSS_BAND_EDGES, LOSS_BAND_LABELS))


def region_coordinates(t: Tables):
    dim = F.broadcast(region_dimension(t.spark).select("region_id", "latitude", "longitude"))
    return aggregates.group_mean(t.regional, ["region_id"], ["carbon_intensity"]).join(dim, "region_id")


_WIN = "OVER (PARTITION BY region_id ORDER BY settlement_period)"
_GOLD_COLUMNS = f"""settlement_period, region_id, dno_region_name, region_name, carbon_intensity, intensity_index,
    carbon_intensity_valid, contains_nulls, {r('rolling_avg_7day', 'rolling_avg_7day')}, lag_1, lag_2, lag_48, lag_336"""
_FEATURE_FILTER = " AND ".join(f"{c} IS NOT NULL" for c in [*[f"{x}_7d_avg" for x in ROLLED], *WIDE, "wind_pct", "solar_pct"])

QUERIES = {
    "align_periods": (
        align_periods,
        sql("aligned", f"SELECT settlement_period, {', '.join(ALIGNED)} FROM aligned"),
    ),
    "weather_interpolated": (
        weather_interpolated,
        sql("weather_on_carbon", f"SELECT settlement_period, {', '.join(r(w, w) for w in WIDE)} FROM weather_on_carbon"),
    ),
    "weather_to_grid": (
        weather_to_grid,
        sql(
            "aligned weather_on_aligned",
            f"SELECT a.*, {', '.join(r('w.' + w, w) for w in WIDE)} FROM aligned a "
            "LEFT JOIN weather_on_aligned w ON w.settlement_period = a.settlement_period",
        ),
    ),
    "penetration": (
        penetration,
        sql(
            "shares",
            f"SELECT settlement_period, {', '.join(r(c, c) for c in ('wind_pct', 'solar_pct', 'low_carbon_pct'))} FROM shares",
        ),
    ),
    "rolling_min_periods": (
        rolling_min_periods,
        sql("windowed", f"SELECT settlement_period, {', '.join(r(c + '_7d_avg', c + '_7d_avg') for c in ROLLED)} FROM windowed"),
    ),
    "lag_features": (
        lag_features,
        sql(
            "windowed",
            "SELECT settlement_period, "
            + ", ".join(
                (r(f"{c}_lag_{n}", f"{c}_lag_{n}") if c == "wind_pct" else f"{c}_lag_{n}") for c, n in LAG_COLUMNS
            )
            + " FROM windowed",
        ),
    ),
    "calendar_features": (calendar_features, sql("aligned", f"SELECT settlement_period, {CALENDAR_SQL} FROM aligned")),
    "national_features": (
        national_features,
        sql(
            "windowed weather_on_aligned",
            "SELECT f.settlement_period, carbon_intensity, intensity_forecast, wind, gas, nuclear, solar, "
            + ", ".join(r(c, c) for c in ("wind_pct", "solar_pct", "low_carbon_pct", *[f"{x}_7d_avg" for x in ROLLED], *WIDE))
            + ", "
            + ", ".join(
                (r(f"{c}_lag_{n}", f"{c}_lag_{n}") if c == "wind_pct" else f"{c}_lag_{n}") for c, n in LAG_COLUMNS
            )
            + f", {CALENDAR_SQL.replace('settlement_period', 'f.settlement_period')} FROM windowed f "
            f"LEFT JOIN weather_on_aligned w ON w.settlement_period = f.settlement_period WHERE {_FEATURE_FILTER}",
        ),
    ),
    "silver_regional": (silver_regional, sql("silver", "SELECT * FROM silver WHERE region_id <= 14")),
    "gold_regional": (gold_regional, sql("gold", f"SELECT {_GOLD_COLUMNS} FROM gold")),
    "weather_half_hourly": (
        weather_half_hourly,
        sql(
            "half_hourly",
            f"""SELECT region_id, region_name, timestamp, {r('temperature', 'temperature')}, {r('wind_speed', 'wind_speed')},
            {r('radiation', 'radiation')}, wind_speed BETWEEN 0 AND 75 AS wind_valid, temperature BETWEEN -15 AND 40
            AS temp_valid, radiation BETWEEN 0 AND 1100 AS rad_valid, (temperature IS NULL OR wind_speed IS NULL OR
            radiation IS NULL) AS has_nulls FROM half_hourly""",
        ),
    ),
    "gold_carbon_weather": (
        gold_carbon_weather,
        sql(
            "gold half_hourly",
            f"""SELECT {_GOLD_COLUMNS}, {r('temperature', 'temperature')}, {r('wind_speed', 'wind_speed')},
            {r('radiation', 'radiation')}, {r('temp_roll_avg_7day', 'temp_roll_avg_7day')} FROM (
            SELECT g.*, h.temperature, h.wind_speed, h.radiation, avg(h.temperature) OVER (PARTITION BY g.region_id
            ORDER BY g.settlement_period ROWS BETWEEN 335 PRECEDING AND CURRENT ROW) AS temp_roll_avg_7day
            FROM gold g JOIN half_hourly h ON h.region_id = g.region_id AND h.timestamp = g.settlement_period)""",
        ),
    ),
    "row_numbers": (
        row_numbers,
        sql(
            "regional",
            f"""SELECT region_id, settlement_period, carbon_intensity, row_number() {_WIN} - 1 AS row_no,
            count(*) OVER (PARTITION BY region_id) AS series_rows FROM regional""",
        ),
    ),
    "duplicate_periods": (
        duplicate_periods,
        sql("ev", "SELECT region_id, slot AS settlement_period, count(*) AS copies FROM ev GROUP BY 1, 2 HAVING count(*) > 1"),
    ),
    "profile": (
        profile,
        sql(
            "regional",
            " UNION ALL ".join(
                f"SELECT '{c}' AS column_name, count({c}) AS n, {r(f'avg({c})', 'mean')}, {r(f'stddev_samp({c})', 'stddev')}, "
                f"{r(f'min({c})', 'min')}, {r(f'max({c})', 'max')} FROM regional"
                for c in ("region_id", "carbon_intensity")
            ),
        ),
    ),
    "group_mean": (
        group_mean,
        sql("regional", f"SELECT region_id, {r('avg(carbon_intensity)', 'mean_carbon_intensity')} FROM regional GROUP BY 1"),
    ),
    "region_counts": (
        region_counts,
        sql("regional", "SELECT count(*) AS n_rows, count(DISTINCT region_id) AS n_region_id FROM regional"),
    ),
    "region_extent": (
        region_extent,
        sql(
            "regional",
            """SELECT region_id, min(settlement_period) AS earliest, max(settlement_period) AS latest, count(*) AS n_rows
            FROM regional GROUP BY 1""",
        ),
    ),
    "median_by_region": (
        median_by_region,
        sql("regional", f"SELECT region_id, {r('quantile_cont(carbon_intensity, 0.5)', 'median_carbon')} FROM regional GROUP BY 1"),
    ),
    "earliest_latest": (
        earliest_latest,
        sql(
            "regional",
            """SELECT *, 'earliest' AS side FROM (SELECT * FROM regional ORDER BY settlement_period, region_id LIMIT 5)
            UNION ALL SELECT *, 'latest' AS side FROM (SELECT * FROM regional ORDER BY settlement_period DESC, region_id LIMIT 5)""",
        ),
    ),
    "high_carbon": (
        high_carbon,
        sql("regional", "SELECT *, carbon_intensity > 250 AS high_carbon FROM regional WHERE carbon_intensity > 200"),
    ),
    "loss_band": (
        loss_band,
        sql(
            "regional",
            f"""SELECT region_id, settlement_period, carbon_intensity, {r('carbon_intensity / 100.0', 'loss')},
            CASE WHEN carbon_intensity > 550 THEN 'HIGH' WHEN carbon_intensity > 210 THEN 'MEDIUM'
            WHEN carbon_intensity > 0 THEN 'LOW' END AS band FROM regional""",
        ),
    ),
    "region_coordinates": (
        region_coordinates,
        sql(
            "regional",
            "SELECT region_id, "
            + r("avg(carbon_intensity)", "mean_carbon_intensity")
            + ", "
            + r("any_value(latitude)", "latitude")
            + ", "
            + r("any_value(longitude)", "longitude")
            + """ FROM regional JOIN (VALUES (1, 57.4778, -4.2247), (2, 55.9533, -3.1883), (3, 53.4808, -2.2426),
            (4, 54.9783, -1.6178), (5, 53.8008, -1.5491), (6, 53.4084, -2.9916), (7, 51.4816, -3.1791),
            (8, 52.4862, -1.8904), (9, 52.9548, -1.1581), (10, 52.6309, 1.2974), (11, 51.4545, -2.5879),
            (12, 50.9097, -1.4044), (13, 51.5074, -0.1278), (14, 50.8229, -0.1363)) AS d(region_id, latitude, longitude)
            USING (region_id) GROUP BY region_id""",
        ),
    ),
}
