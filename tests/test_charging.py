import datetime as dt
import itertools

import numpy as np
import pytest

from tests.helpers import START, period
from wattline.operators import charging as ch

SESSION = "session_id string, region_id long, arrival_time timestamp, departure_time timestamp, energy_kwh double"
FORECAST = "region_id long, slot timestamp, carbon_intensity double, price double"


def forecast(spark, carbon, price=None):
    rows = [(1, period(i), float(c), float(price[i] if price else 10.0)) for i, c in enumerate(carbon)]
    return spark.createDataFrame(rows, FORECAST)


def session(spark, *rows):
    return spark.createDataFrame(
        [(f"s{i}", 1, START + dt.timedelta(minutes=a), START + dt.timedelta(minutes=b), float(e)) for i, (a, b, e) in enumerate(rows)],
        SESSION,
    )


def rates(df, column):
    return [r[column] for r in df.orderBy("slot").collect()]


def test_cleanest_slot_first(spark):
    slots = ch.session_slots(session(spark, (0, 60, 3.0)), forecast(spark, [10, 100]))
    got = ch.schedules(slots, 4.0)
    assert rates(got, "optimal_kw") == [4.0, 2.0]
    swapped = ch.schedules(ch.session_slots(session(spark, (0, 60, 3.0)), forecast(spark, [100, 10])), 4.0)
    assert rates(swapped, "optimal_kw") == [2.0, 4.0] and rates(swapped, "plain_kw") == [4.0, 2.0]


def test_only_whole_slots_inside_the_stay(spark):
    slots = ch.session_slots(session(spark, (10, 125, 1.0)), forecast(spark, [1] * 6))
    assert [r["slot"].timestamp() for r in slots.orderBy("slot").collect()] == [period(i).timestamp() for i in (1, 2, 3)]


def test_plain_schedule_has_a_partial_last_slot(spark):
    slots = ch.session_slots(session(spark, (0, 240, 5.0)), forecast(spark, [1] * 8))
    assert rates(ch.schedules(slots, 3.7), "plain_kw") == pytest.approx([3.7, 3.7, 2.6, 0, 0, 0, 0, 0])


def test_optimum_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    carbon = [int(c) for c in rng.integers(0, 300, 6)]
    need, rate = 5, 4  # kWh; one slot gives 2 kWh
    best = min(
        sum(k * c for k, c in zip(take, carbon))
        for take in itertools.product([0, 1, 2], repeat=6)
        if sum(take) >= need
    )
    scheduled = ch.schedules(ch.session_slots(session(spark, (0, 180, need)), forecast(spark, carbon)), rate)
    got = scheduled.selectExpr("sum(optimal_kw * 0.5 * carbon_intensity) g", "sum(optimal_kw) * 0.5 e").first()
    assert got["g"] == pytest.approx(best) and got["e"] == pytest.approx(need)


def test_composition_and_savings(spark):
    sessions = session(spark, (0, 60, 2.0), (0, 30, 10.0), (60, 240, 4.0))
    got = {r["session_id"]: r for r in ch.optimise_sessions(sessions, forecast(spark, [100, 10, 5], [20, 8, 5]), 4.0).collect()}
    assert got["s0"]["status"] == "optimal"
    assert got["s0"]["carbon_saving_g"] == pytest.approx(2 * (100 - 10))
    assert got["s0"]["cost_saving_gbp"] == pytest.approx(2 * (20 - 8) / 100)
    assert got["s1"]["status"] == "infeasible" and got["s1"]["carbon_saving_g"] is None
    assert got["s2"]["status"] == "short_forecast"


def test_session_features_and_filter(spark):
    df = session(spark, (630, 690, 5.0), (0, 20, 5.0), (0, 60, 151.0), (0, 60 * 49, 5.0))
    features = ch.session_features(df)
    first = features.filter("session_id = 's0'").first()
    assert first["arrival_hour"] == 10.5 and first["duration_hours"] == 1.0 and first["day_of_week"] == 0
    assert [r["session_id"] for r in ch.valid_sessions(features).collect()] == ["s0"]
    assert ch.energy_histogram(features, 0.0, 100.0, 10).filter("bucket = 11").first()["n_sessions"] == 1


def test_greenest_window_and_bands(spark):
    carbon = [9, 9, 9, 1, 1, 1, 1, 1, 1, 1, 1, 9, 9]
    got = ch.greenest_window(forecast(spark, carbon)).first()
    assert got["window_start"].timestamp() == period(3).timestamp() and got["mean_carbon"] == 1.0
    bands = ch.intensity_band(forecast(spark, [50, 150, 400]), 100, 300).orderBy("slot").collect()
    assert [r["band"] for r in bands] == ["green", "amber", "red"]


def test_slots_reuse_the_session_partitioning(spark):
    """One exchange of sessions, none of the expanded slots, when the forecast is broadcast."""
    slots = ch.schedules(ch.session_slots(session(spark, (0, 60, 2.0)), forecast(spark, [1, 2])), 4.0)
    plan = slots._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(session_id") == 1 or plan.count("REPARTITION_BY_COL") == 1
