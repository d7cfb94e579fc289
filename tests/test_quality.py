import datetime as dt

import pytest

from tests.helpers import START, period
from wattline.operators import quality as q

CARBON = "settlement_period timestamp, intensity_actual int, intensity_forecast int"
SESSION = "session_id string, station_id string, arrival_time timestamp, departure_time timestamp, energy_kwh double"


def carbon(spark, rows):
    return spark.createDataFrame(rows, CARBON)


def fields(df):
    return sorted((r["rule_no"], r["field"]) for r in df.collect())


def test_carbon_rules(spark):
    clean = carbon(spark, [(period(0), 0, 800), (period(1), None, 5)])
    assert q.check_carbon(clean).count() == 0
    q.require(q.check_carbon(clean))
    assert q.check_carbon(carbon(spark, [])).count() == 0
    assert fields(q.check_carbon(carbon(spark, [(period(0), 801, -1)]))) == [(4, "intensity_actual"), (5, "intensity_forecast")]
    assert fields(q.check_carbon(carbon(spark, [(None, 1, 1)]))) == [(1, "settlement_period")]
    assert (3, "settlement_period") in fields(q.check_carbon(carbon(spark, [(period(0), 1, 1), (period(2), 1, 1)])))
    assert (2, "settlement_period") in fields(q.check_carbon(carbon(spark, [(period(0), 1, 1), (period(0), 1, 1)])))


def test_strict_raises_the_lowest_rule(spark):
    bad = carbon(spark, [(period(0), 900, 1), (period(0), 1, 1)])
    with pytest.raises(q.QualityError) as error:
        q.require(q.check_carbon(bad))
    assert error.value.field == "settlement_period"


def test_generation_rules(spark):
    ts = "settlement_period timestamp, gas double, wind double"
    one = spark.createDataFrame([(period(0), 100.0, 4.0), (period(1), 100.0, None)], ts)
    assert q.check_generation(one).count() == 0
    assert fields(q.check_generation(spark.createDataFrame([(period(0), -1.0, 0.0)], ts))) == [(4, "gas")]
    assert fields(q.check_generation(spark.createDataFrame([(period(0), 50.0, 50.0)], ts))) == [(q.SUM_RULE, "multiple")]
    total = ts + ", total double"
    stated = spark.createDataFrame([(period(0), 50.0, 50.0, 100.0), (period(1), 50.0, 50.0, 106.0)], total)
    assert fields(q.check_generation(stated)) == [(q.SUM_RULE, "total")]


def test_weather_rules(spark):
    schema = "city string, timestamp timestamp, temperature double, wind_speed double, radiation double"
    rows = [("London", period(0), -30.0, 150.0, 0.0), ("Manchester", period(0), 51.0, 151.0, -1.0), ("Edinburgh", period(0), 5.0, 5.0, 5.0),
            ("London", period(2), 1.0, 1.0, 1.0)]
    got = q.check_weather(spark.createDataFrame(rows, schema))
    assert fields(got) == [(1, "temperature"), (2, "wind_speed"), (3, "radiation"), (4, "city")]
    assert got.filter("rule_no = 4").first()["message"] == "cities without a row: Edinburgh, Manchester"


def session(i, hours, kwh, station="st"):
    return (f"s{i}", station, START, START + dt.timedelta(hours=hours), kwh)


def test_session_rules_and_report(spark):
    sessions = spark.createDataFrame([session(1, 1, 5.0), session(2, -1, 5.0), session(3, 1, 0.0), session(4, 1, 1.0, None)], SESSION)
    assert fields(q.check_sessions(sessions)) == [(1, "energy_kwh"), (2, "departure_time"), (4, "station_id")]
    frames = {
        "carbon_intensity": carbon(spark, [(period(0), 900, 900), (period(1), 1, 1), (period(2), -5, 1)]),
        "ev_sessions": spark.createDataFrame([session(1, 1, 5.0), session(2, 1, -2.0)], SESSION),
        "generation_mix": spark.createDataFrame([(period(0), 1.0)], "settlement_period timestamp, gas double"),
        "unknown": sessions,
    }
    counts = {r["source"]: r["n_messages"] for r in q.report_counts(frames).collect()}
    assert counts == {"carbon_intensity": 2, "ev_sessions": 1}
