"""Shared input tables: as DataFrames for the queries and as SQL for their checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.sources import bindings

SCALE = 1e6
# Slightly above a half: decimal ties, which binary floats miss by a hair, all go up.
HALF_UP = 0.5001


class Tables:
    """Domain tables of one test folder, built on demand."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.events = bindings.events(spark, sf_dir)

    def __getattr__(self, name: str) -> DataFrame:
        return getattr(bindings, name)(self.events)


def out(df: DataFrame) -> DataFrame:
    """Result form: zone-less times and floats rounded to six places."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.floor(c.cast("double") * SCALE + HALF_UP) / SCALE
        columns.append(c.alias(f.name))
    return df.select(*columns)


def r(expr: str, name: str) -> str:
    """The same rounding in SQL."""
    return f"floor(CAST({expr} AS DOUBLE) * 1e6 + 0.5001e0) / 1e6 AS {name}"


# Common table expressions by name, with the names each needs.
_CTE: dict[str, tuple[list[str], str]] = {
    "ev": (
        [],
        """SELECT event_id, ts, user_id, event_type, value, CAST(round(value * 100) AS BIGINT) AS cents,
           CAST(json_extract_string(props, '$.k') AS INT) AS k,
           time_bucket(INTERVAL '30 minutes', ts) AS slot, user_id % 14 + 1 AS region_id FROM events""",
    ),
    "carbon": (
        ["ev"],
        """SELECT slot AS settlement_period,
           CAST(least(800, sum(cents) // (25 * count(*))) AS INT) AS intensity_actual,
           CAST(least(800, max(cents) // 25) AS INT) AS intensity_forecast
           FROM ev WHERE event_type = 'view' GROUP BY slot""",
    ),
    "generation": (
        ["ev"],
        "SELECT slot AS settlement_period, "
        + ", ".join(
            f"CAST(sum(CASE WHEN event_type = '{kind}' THEN cents END) AS DOUBLE) / 100 AS {fuel}"
            for fuel, kind in {"wind": "click", "gas": "error", "nuclear": "purchase", "solar": "signup"}.items()
        )
        + " FROM ev GROUP BY slot",
    ),
    "weather": (
        ["ev"],
        """SELECT CASE user_id % 3 WHEN 0 THEN 'London' WHEN 1 THEN 'Manchester' ELSE 'Edinburgh' END AS city,
           date_trunc('hour', ts) AS timestamp, CAST(sum(cents) AS DOUBLE) / (1000 * count(*)) AS temperature,
           CAST(sum(k) AS DOUBLE) / count(*) AS wind_speed, max(value) AS radiation
           FROM ev GROUP BY 1, 2""",
    ),
    "regional_weather": (
        ["ev"],
        """SELECT region_id, concat('Region ', region_id) AS region_name, date_trunc('hour', ts) AS timestamp,
           CAST(sum(cents) AS DOUBLE) / (1000 * count(*)) AS temperature,
           CAST(sum(k) AS DOUBLE) / count(*) AS wind_speed, max(value) AS radiation
           FROM ev GROUP BY 1, 3""",
    ),
    "regional": (
        ["ev"],
        """SELECT region_id, slot AS settlement_period,
           CAST(sum(cents) // (25 * count(*)) AS BIGINT) AS carbon_intensity FROM ev GROUP BY 1, 2""",
    ),
    "bronze": (
        ["regional"],
        """SELECT settlement_period AS period_from, settlement_period + INTERVAL 30 MINUTE AS period_to, region_id,
           concat(' DNO ', region_id, ' ') AS dno_region_name, concat('Region ', region_id, ' ') AS region_name,
           carbon_intensity, CASE WHEN carbon_intensity < 200 THEN 'low' WHEN carbon_intensity < 400
           THEN 'moderate' ELSE 'high' END AS intensity_index FROM regional""",
    ),
    "silver": (
        ["bronze"],
        """SELECT period_from AS settlement_period, region_id, trim(dno_region_name) AS dno_region_name,
           trim(region_name) AS region_name, carbon_intensity, trim(intensity_index) AS intensity_index,
           carbon_intensity >= 0 AS carbon_intensity_valid, (carbon_intensity IS NULL OR region_id IS NULL)
           AS contains_nulls FROM bronze""",
    ),
    "gold": (
        ["silver"],
        """SELECT *, avg(carbon_intensity) OVER (PARTITION BY region_id ORDER BY settlement_period
           ROWS BETWEEN 335 PRECEDING AND CURRENT ROW) AS rolling_avg_7day, """
        + ", ".join(
            f"lag(carbon_intensity, {n}) OVER (PARTITION BY region_id ORDER BY settlement_period) AS lag_{n}"
            for n in (1, 2, 48, 336)
        )
        + " FROM silver",
    ),
    "half_hourly": (
        ["regional_weather"],
        """SELECT region_id, region_name, unnest(CASE WHEN nxt IS NULL THEN [timestamp] ELSE
           generate_series(timestamp, nxt - INTERVAL 30 MINUTE, INTERVAL 30 MINUTE) END) AS timestamp,
           temperature, wind_speed, radiation FROM (SELECT *, lead(timestamp) OVER (PARTITION BY region_id
           ORDER BY timestamp) AS nxt FROM regional_weather)""",
    ),
    "sessions": (
        ["ev"],
        """SELECT concat('sess_', event_id) AS session_id, concat('station_', user_id % 20) AS station_id, region_id,
           ts AS arrival_time, ts + (k - 2) * INTERVAL 15 MINUTE AS departure_time, value / 4 AS energy_kwh
           FROM ev WHERE event_type = 'purchase'""",
    ),
    "dense": (
        ["regional"],
        """SELECT region_id, slot, CAST(c AS BIGINT) AS carbon_intensity, CAST(c % 32 + 4 AS DOUBLE) AS price FROM (
           SELECT g.region_id, g.slot, coalesce(last_value(r.carbon_intensity IGNORE NULLS) OVER (PARTITION BY g.region_id
           ORDER BY g.slot ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value(r.carbon_intensity IGNORE NULLS)
           OVER (PARTITION BY g.region_id ORDER BY g.slot ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS c
           FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 30 MINUTE)) AS slot, region_id
                 FROM (SELECT min(slot) AS lo, max(slot) AS hi FROM ev), (SELECT unnest(range(1, 15)) AS region_id)) g
           LEFT JOIN regional r ON r.region_id = g.region_id AND r.settlement_period = g.slot)""",
    ),
}


def add_cte(name: str, needs: list[str], sql: str) -> None:
    _CTE[name] = (needs, sql)


def _ordered(names: list[str], seen: list[str]) -> list[str]:
    for n in names:
        if n not in seen:
            _ordered(_CTE[n][0], seen)
            seen.append(n)
    return seen


def sql(needs: str, select: str) -> str:
    """``select`` over the named tables (space separated), with all they need before it."""
    parts = [f"{n} AS ({_CTE[n][1]})" for n in _ordered(needs.split(), [])]
    return "WITH " + ",\n".join(parts) + "\n" + select


# ---- alignment and national features ------------------------------------------------------

ALIGNED = ["intensity_actual", "intensity_forecast", "wind", "gas", "nuclear", "solar"]


def _aligned_sql() -> str:
    runs = ", ".join(f"count({c}) OVER (ORDER BY settlement_period) AS run_{c}" for c in ALIGNED)
    values = ", ".join(
        f"""CASE WHEN {c} IS NOT NULL THEN {c} WHEN count(*) FILTER ({c} IS NULL) OVER (PARTITION BY run_{c}) <= 3
            THEN last_value({c} IGNORE NULLS) OVER (ORDER BY settlement_period ROWS BETWEEN UNBOUNDED PRECEDING
            AND CURRENT ROW) END AS {c}"""
        for c in ALIGNED
    )
    present = " AND ".join(f"{c} IS NOT NULL" for c in ALIGNED)
    return f"""SELECT * FROM (SELECT settlement_period, {values} FROM (SELECT *, {runs} FROM (
        SELECT g.settlement_period, c.intensity_actual, c.intensity_forecast, m.wind, m.gas, m.nuclear, m.solar
        FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 30 MINUTE)) AS settlement_period FROM (
              SELECT min(settlement_period) AS lo, max(settlement_period) AS hi FROM (
              SELECT settlement_period FROM carbon UNION ALL SELECT settlement_period FROM generation))) g
        LEFT JOIN carbon c ON c.settlement_period = g.settlement_period
        LEFT JOIN generation m ON m.settlement_period = g.settlement_period))) WHERE {present}"""


add_cte("aligned", ["carbon", "generation"], _aligned_sql())
add_cte(
    "shares",
    ["aligned"],
    """SELECT settlement_period, intensity_actual AS carbon_intensity, intensity_forecast, wind, gas, nuclear, solar,
       wind / nullif(gas + nuclear + wind + solar, 0) * 100 AS wind_pct,
       solar / nullif(gas + nuclear + wind + solar, 0) * 100 AS solar_pct,
       (nuclear + wind + solar) / nullif(gas + nuclear + wind + solar, 0) * 100 AS low_carbon_pct FROM aligned""",
)
ROLLED = ["wind_pct", "solar_pct", "carbon_intensity"]
LAG_COLUMNS = [(c, n) for c in ("carbon_intensity", "wind_pct") for n in (1, 2, 48, 336)]
add_cte(
    "windowed",
    ["shares"],
    "SELECT *, "
    + ", ".join(
        f"CASE WHEN count({c}) OVER w >= 48 THEN avg({c}) OVER w END AS {c}_7d_avg" for c in ROLLED
    )
    + ", "
    + ", ".join(f"lag({c}, {n}) OVER (ORDER BY settlement_period) AS {c}_lag_{n}" for c, n in LAG_COLUMNS)
    + " FROM shares WINDOW w AS (ORDER BY settlement_period ROWS BETWEEN 335 PRECEDING AND CURRENT ROW)",
)
WIDE = [f"{c}_{v}" for c in ("edinburgh", "london", "manchester") for v in ("temperature", "wind_speed", "radiation")]
add_cte(
    "wide_weather",
    ["weather"],
    "SELECT timestamp, "
    + ", ".join(
        f"max(CASE WHEN lower(city) = '{w.split('_', 1)[0]}' THEN {w.split('_', 1)[1]} END) AS {w}" for w in WIDE
    )
    + " FROM weather GROUP BY timestamp",
)


def interpolation_sql(grid: str) -> str:
    """Weather at the times of table ``grid`` (column settlement_period)."""
    before = "OVER (ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    after = "OVER (ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    near = ", ".join(
        f"""last_value({w} IGNORE NULLS) {before} AS pv_{w}, max(CASE WHEN {w} IS NOT NULL THEN t END) {before} AS pt_{w},
            first_value({w} IGNORE NULLS) {after} AS nv_{w}, min(CASE WHEN {w} IS NOT NULL THEN t END) {after} AS nt_{w}"""
        for w in WIDE
    )
    value = ", ".join(
        f"""CASE WHEN pt_{w} = t OR nt_{w} IS NULL THEN pv_{w} ELSE pv_{w} + (nv_{w} - pv_{w}) *
            CAST(epoch_us(t) - epoch_us(pt_{w}) AS DOUBLE) / nullif(epoch_us(nt_{w}) - epoch_us(pt_{w}), 0) END AS {w}"""
        for w in WIDE
    )
    return f"""SELECT t AS settlement_period, {value} FROM (SELECT *, {near} FROM (
        SELECT u.t, w.* EXCLUDE (timestamp) FROM (SELECT settlement_period AS t FROM {grid}
        UNION SELECT timestamp FROM wide_weather) u LEFT JOIN wide_weather w ON w.timestamp = u.t))
        WHERE t IN (SELECT settlement_period FROM {grid})"""


add_cte("weather_on_carbon", ["carbon", "wide_weather"], interpolation_sql("carbon"))
add_cte("weather_on_aligned", ["aligned", "wide_weather"], interpolation_sql("aligned"))
CALENDAR_SQL = f"""CAST(hour(settlement_period) AS INT) AS hour_of_day,
    CAST(isodow(settlement_period) - 1 AS INT) AS day_of_week, CAST(dayofyear(settlement_period) AS INT) AS day_of_year,
    CAST(month(settlement_period) AS INT) AS month, isodow(settlement_period) >= 6 AS is_weekend,
    {r("sin(2 * pi() * dayofyear(settlement_period) / 365)", "season_sin")},
    {r("cos(2 * pi() * dayofyear(settlement_period) / 365)", "season_cos")},
    CAST(settlement_period AS DATE) IN (DATE '2024-01-01', DATE '2024-03-29', DATE '2024-03-31', DATE '2024-04-01',
    DATE '2024-05-06', DATE '2024-05-27', DATE '2024-08-26', DATE '2024-12-25', DATE '2024-12-26') AS is_bank_holiday_uk"""
