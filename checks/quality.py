"""Data-quality rules."""

from __future__ import annotations

from checks.common import Tables, sql
from wattline.operators import quality

TIME = "strftime({}, '%Y-%m-%d %H:%M:%S')"


def quality_carbon(t: Tables):
    return quality.check_carbon(
        t.regional.withColumnRenamed("carbon_intensity", "intensity_actual"), keys=["region_id"]
    )


def quality_generation(t: Tables):
    return quality.check_generation(t.generation)


def quality_weather(t: Tables):
    return quality.check_weather(t.weather)


def quality_sessions(t: Tables):
    return quality.check_sessions(t.sessions)


def _frames(t: Tables):
    return {
        "carbon_intensity": t.regional.withColumnRenamed("carbon_intensity", "intensity_actual"),
        "generation_mix": t.generation,
        "ev_sessions": t.sessions,
        "weather": t.weather,
    }


def quality_report(t: Tables):
    return quality.report(_frames(t))


def quality_report_counts(t: Tables):
    return quality.report_counts(_frames(t))


_SP = TIME.format("settlement_period")
_RSP = f"concat(region_id, '/', {_SP})"
_FUEL_SUM = "coalesce(gas, 0) + coalesce(nuclear, 0) + coalesce(wind, 0) + coalesce(solar, 0)"
_FUEL_BAD = f"({_FUEL_SUM}) > 1.05e0 * greatest(gas, nuclear, wind, solar)"
_SESSION_RULES = [
    (1, "energy_kwh", "energy_kwh <= 0", "not above 0"),
    (2, "departure_time", "departure_time <= arrival_time", "departs no later than it arrives"),
    (4, "station_id", "station_id IS NULL", "no station"),
]
_WEATHER_RULES = [
    (1, "temperature", "temperature < -30 OR temperature > 50", "outside -30.0 to 50.0"),
    (2, "wind_speed", "wind_speed < 0 OR wind_speed > 150", "outside 0.0 to 150.0"),
    (3, "radiation", "radiation < 0", "below 0.0"),
]
_WKEY = f"concat(city, '/', {TIME.format('timestamp')})"


def _rows(source: str, table: str, rules, key: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{source}' AS source, {no} AS rule_no, '{field}' AS field, {key} AS key, '{text}' AS message "
        f"FROM {table} WHERE {test}"
        for no, field, test, text in rules
    )


_REPORT = f"""
    SELECT 'carbon_intensity' AS source, 4 AS rule_no, 'intensity_actual' AS field, {_SP} AS key,
        'outside 0 to 800' AS message FROM regional WHERE carbon_intensity < 0 OR carbon_intensity > 800
    UNION ALL SELECT 'generation_mix', 13, 'multiple', {_SP}, 'fuels add up to over 1.05 times the largest' FROM generation
        WHERE {_FUEL_BAD}
    UNION ALL SELECT 'ev_sessions', CASE WHEN energy_kwh <= 0 THEN 1 ELSE 2 END,
        CASE WHEN energy_kwh <= 0 THEN 'energy_kwh' ELSE 'departure_time' END, session_id,
        CASE WHEN energy_kwh <= 0 THEN 'not above 0' ELSE 'departs no later than it arrives' END
        FROM sessions WHERE energy_kwh <= 0 OR departure_time <= arrival_time
    UNION ALL SELECT 'weather', CASE WHEN temperature < -30 OR temperature > 50 THEN 1 WHEN wind_speed < 0 OR
        wind_speed > 150 THEN 2 WHEN radiation < 0 THEN 3 ELSE 4 END, CASE WHEN temperature < -30 OR temperature > 50
        THEN 'temperature' WHEN wind_speed < 0 OR wind_speed > 150 THEN 'wind_speed' WHEN radiation < 0 THEN 'radiation'
        ELSE 'city' END, {_WKEY}, CASE WHEN temperature < -30 OR temperature > 50 THEN 'outside -30.0 to 50.0'
        WHEN wind_speed < 0 OR wind_speed > 150 THEN 'outside 0.0 to 150.0' WHEN radiation < 0
        THEN 'below 0.0' ELSE 'other cities lack this time' END FROM weather"""

QUERIES = {
    "quality_carbon": (
        quality_carbon,
        sql(
            "regional",
            _rows(
                "carbon_intensity", "regional",
                [(4, "intensity_actual", "carbon_intensity < 0 OR carbon_intensity > 800", "outside 0 to 800")], _RSP,
            )
            + f""" UNION ALL SELECT 'carbon_intensity', 3, 'settlement_period', {_RSP}, 'Expected 30 minutes between rows'
            FROM (SELECT *, lag(settlement_period) OVER (PARTITION BY region_id ORDER BY settlement_period) AS p FROM regional)
            WHERE settlement_period - p <> INTERVAL 30 MINUTE""",
        ),
    ),
    "quality_generation": (
        quality_generation,
        sql(
            "generation",
            _rows(
                "generation_mix", "generation",
                [(13, "multiple", _FUEL_BAD, "fuels add up to over 1.05 times the largest")], _SP,
            )
            + f""" UNION ALL SELECT 'generation_mix', 3, 'settlement_period', {_SP}, 'Expected 30 minutes between rows'
            FROM (SELECT *, lag(settlement_period) OVER (ORDER BY settlement_period) AS p FROM generation)
            WHERE settlement_period - p <> INTERVAL 30 MINUTE""",
        ),
    ),
    "quality_weather": (
        quality_weather,
        sql(
            "weather",
            _rows("weather", "weather", _WEATHER_RULES, _WKEY)
            + f""" UNION ALL SELECT 'weather', 4, 'city', {TIME.format('timestamp')}, concat('cities without a row: ',
            array_to_string(list_filter(['Edinburgh', 'London', 'Manchester'], lambda x: NOT list_contains(cities, x)), ', '))
            FROM (SELECT timestamp, list(DISTINCT city) AS cities FROM weather GROUP BY 1) WHERE len(cities) < 3""",
        ),
    ),
    "quality_sessions": (quality_sessions, sql("sessions", _rows("ev_sessions", "sessions", _SESSION_RULES, "session_id"))),
    "quality_report": (quality_report, sql("regional generation sessions weather", _REPORT)),
    "quality_report_counts": (
        quality_report_counts,
        sql(
            "regional generation sessions weather",
            f"SELECT source, count(*) AS n_messages FROM ({_REPORT}) GROUP BY 1",
        ),
    ),
}
