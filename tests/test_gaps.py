import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.helpers import START, epochs, period
from wattline.operators.features import join_weather
from wattline.operators.gaps import align, carry_onto, ffill_short_runs, interpolate_onto, time_grid, upsample_last_row

CARBON = "settlement_period timestamp, intensity_actual int, intensity_forecast int"
MIX = "settlement_period timestamp, wind double, gas double"


def pair(spark, n, missing):
    carbon = [(period(i), 200 + i, 201 + i) for i in range(n) if i not in missing]
    mix = [(period(i), 1.0 * i, 2.0) for i in range(n)]
    return spark.createDataFrame(carbon, CARBON), spark.createDataFrame(mix, MIX)


@pytest.mark.parametrize(
    "n, missing, rows", [(5, {2}, 5), (8, {2, 3, 4}, 8), (10, {3, 4, 5, 6}, 6), (6, {3, 4, 5}, 6), (6, {0}, 5)]
)
def test_align_known_answers(spark, n, missing, rows):
    got = align(*pair(spark, n, missing)).orderBy("settlement_period").collect()
    assert len(got) == rows
    if missing == {2}:
        assert got[2]["intensity_actual"] == 201


def test_align_fills_null_values_not_only_absent_rows(spark):
    carbon = spark.createDataFrame([(period(i), None if i in (1, 2) else i, 5) for i in range(5)], CARBON)
    mix = spark.createDataFrame([(period(i), 1.0, 2.0) for i in range(5)], MIX)
    got = align(carbon, mix).orderBy("settlement_period").collect()
    assert [r["intensity_actual"] for r in got] == [0, 0, 0, 3, 4]


def test_align_drops_off_grid_rows_and_refuses_duplicates(spark):
    carbon, mix = pair(spark, 4, set())
    odd = spark.createDataFrame([(START + dt.timedelta(minutes=40), 1, 1)], CARBON)
    assert align(carbon.unionByName(odd), mix).count() == 4
    with pytest.raises(Exception, match="duplicate settlement_period"):
        align(carbon.unionByName(carbon.limit(1)), mix).collect()


def test_align_empty(spark):
    empty = spark.createDataFrame([], CARBON), spark.createDataFrame([], MIX)
    assert align(*empty).count() == 0


@pytest.mark.parametrize("chunk_rows", [10, 64, 5000])
def test_short_runs_in_any_chunking(spark, chunk_rows):
    rng = np.random.default_rng(11)
    values = np.where(rng.random(600) < 0.55, np.nan, rng.integers(0, 9, 600))
    known = [i for i, v in enumerate(values) if not np.isnan(v)]
    filled = values.copy()
    for here, following in zip(known, [*known[1:], len(values)]):
        if following - here - 1 <= 3:
            filled[here:following] = values[here]
    expected = pd.Series(filled)
    rows = [(7, i, None if np.isnan(v) else float(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "k int, _idx long, c double")
    got = ffill_short_runs(df, ["c"], ["k"], chunk_rows=chunk_rows).orderBy("_idx").toPandas()["c"].astype(float)
    pd.testing.assert_series_equal(got, expected, check_names=False)


def test_grid_of_many_blocks(spark):
    bounds = spark.createDataFrame([(1, START, START + dt.timedelta(minutes=30 * 9999))], "k int, lo timestamp, hi timestamp")
    grid = time_grid(bounds, ["k"], "t", "lo", "hi")
    row = grid.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("t").alias("d"), F.max("_idx").alias("m")).first()
    assert (row["n"], row["d"], row["m"]) == (10000, 10000, 9999)


def weather_rows(spark, rows):
    return spark.createDataFrame(rows, "city string, timestamp timestamp, temperature double, wind_speed double, radiation double")


def test_midpoint_and_names(spark):
    weather = weather_rows(spark, [("New Town", period(0), 10.0, 1.0, 0.0), ("New Town", period(2), 20.0, 1.0, 0.0)])
    grid = spark.createDataFrame([(period(i),) for i in range(3)], "settlement_period timestamp")
    got = join_weather(grid, weather).orderBy("settlement_period").collect()
    assert [r["new_town_temperature"] for r in got] == [10.0, 15.0, 20.0]
    assert set(got[0].asDict()) == {"settlement_period", "new_town_temperature", "new_town_wind_speed", "new_town_radiation"}


def test_interpolation_outside_the_observations(spark):
    obs = spark.createDataFrame([(period(2), 1.0), (period(4), 3.0)], "settlement_period timestamp, v double")
    grid = spark.createDataFrame([(period(i),) for i in range(7)], "settlement_period timestamp")
    held = interpolate_onto(grid, obs, ["v"], "settlement_period").orderBy("settlement_period").collect()
    assert [r["v"] for r in held] == [None, None, 1.0, 2.0, 3.0, 3.0, 3.0]
    strict = interpolate_onto(grid, obs, ["v"], "settlement_period", extrapolate=False).orderBy("settlement_period").collect()
    assert [r["v"] for r in strict] == [None, None, 1.0, 2.0, 3.0, None, None]


@pytest.mark.parametrize("bucket", ["1 hour", "1 day", "28 days"])
def test_interpolation_reaches_across_buckets(spark, bucket):
    rng = np.random.default_rng(5)
    frames, expected = [], []
    grid_index = pd.date_range("2024-01-01", periods=400, freq="30min", tz="UTC")
    for key in (1, 2):
        at = np.sort(rng.choice(200, 25, replace=False))
        obs = pd.DataFrame({"k": key, "t": pd.Timestamp("2024-01-01", tz="UTC") + pd.to_timedelta(at, "h"), "v": rng.random(25)})
        obs.loc[rng.choice(25, 5, replace=False), "v"] = np.nan
        some = obs["v"].notna().to_numpy()
        halves = np.arange(400) / 2  # hours of the grid
        frames.append(obs)
        expected.append(np.interp(halves, at[some], obs["v"].to_numpy()[some], left=np.nan))
    obs = pd.concat(frames)
    rows = [(int(k), t.to_pydatetime(), None if np.isnan(v) else float(v)) for k, t, v in obs.itertuples(index=False)]
    observed = spark.createDataFrame(rows, "k int, t timestamp, v double")
    grid = spark.createDataFrame([(k, t.to_pydatetime()) for k in (1, 2) for t in grid_index], "k int, t timestamp")
    got = interpolate_onto(grid, observed, ["v"], "t", ["k"], bucket=bucket).orderBy("k", "t").toPandas()["v"].to_numpy(float)
    np.testing.assert_allclose(got, np.concatenate(expected), rtol=1e-9, equal_nan=True)


def test_full_bucket_uses_a_narrower_width(spark, monkeypatch):
    from wattline.operators import chunks

    monkeypatch.setattr(chunks.fitting_width, "__defaults__", (20,))
    obs = spark.createDataFrame([(period(i), float(i)) for i in range(0, 200, 2)], "t timestamp, v double")
    grid = spark.createDataFrame([(period(i),) for i in range(200)], "t timestamp")
    assert chunks.fitting_width(obs, [], "t", "28 days") == "1 hour"
    got = [r["v"] for r in interpolate_onto(grid, obs, ["v"], "t").orderBy("t").collect()]
    assert got == [float(min(i, 198)) for i in range(200)]


def test_carry_then_backfill(spark):
    obs = spark.createDataFrame([(period(100), 5.0), (period(300), 7.0)], "t timestamp, v double")
    grid = spark.createDataFrame([(period(i),) for i in range(400)], "t timestamp")
    got = [r["v"] for r in carry_onto(grid, obs, ["v"], "t", bucket="1 day").orderBy("t").collect()]
    assert got == [5.0] * 300 + [7.0] * 100


def test_upsample_repeats_rows_and_stops_at_the_last(spark):
    rows = [(1, period(0), 1.0), (1, period(2), None), (1, period(6), 3.0), (2, period(0), 9.0)]
    df = spark.createDataFrame(rows, "k int, t timestamp, v double")
    got = upsample_last_row(df, "t", ["k"], chunk_rows=2).orderBy("k", "t").collect()
    assert [(r["k"], r["v"]) for r in got] == [(1, 1.0), (1, 1.0), (1, None), (1, None), (1, None), (1, None), (1, 3.0), (2, 9.0)]
    assert epochs(got, "t")[1] == period(1).timestamp()
