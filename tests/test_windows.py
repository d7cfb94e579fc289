import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window

from tests.helpers import period
from wattline.operators.chunks import cut
from wattline.operators.windows import (
    add_windows,
    duplicate_times,
    irregular_intervals,
    lag_columns,
    rolling_mean,
    row_index,
)


def series(spark, values):
    rows = [(period(i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "settlement_period timestamp, x double")


def test_rolling_known_answers(spark):
    got = rolling_mean(series(spark, range(100)), ["x"], "settlement_period", min_periods=48)
    values = [r["x_7d_avg"] for r in got.orderBy("settlement_period").collect()]
    assert values[46] is None
    assert values[47] == pytest.approx(23.5)
    assert values[99] == pytest.approx(49.5)


def test_absent_columns_are_skipped(spark):
    df = series(spark, range(3))
    assert rolling_mean(df, ["y"], "settlement_period").columns == df.columns
    assert lag_columns(df, ["y"], "settlement_period").columns == df.columns


def test_lags_known_answers(spark):
    got = lag_columns(series(spark, range(10)), ["x"], "settlement_period").orderBy("settlement_period").collect()
    assert got[5]["x_lag_1"] == 4 and got[5]["x_lag_2"] == 3 and got[5]["x_lag_48"] is None


def random_series(spark, rows=1500, hot=4000):
    rng = np.random.default_rng(3)
    data = []
    for key, n, pace in [(1, hot, 3), (2, rows, 400), (None, rows, 60)]:
        t = pd.Timestamp("2023-12-30", tz="UTC")
        for _ in range(n):
            t += pd.Timedelta(minutes=int(rng.integers(1, pace)))
            data.append((key, t.to_pydatetime(), None if rng.random() < 0.1 else int(rng.integers(0, 800))))
    return spark.createDataFrame(data, "k long, t timestamp, v long")


@pytest.mark.parametrize("chunk_rows", [336, 500, 20000])
def test_chunks_equal_plain_windows(spark, chunk_rows):
    df = random_series(spark)
    got = add_windows(
        df, "t", ["k"], means={"m": "v", "d": ("v", 48)}, lags={"l1": ("v", 1), "l336": ("v", 336)}, min_periods=10,
        chunk_rows=chunk_rows,
    )
    w = Window.partitionBy("k").orderBy("t")

    def mean(n):
        frame = w.rowsBetween(-(n - 1), 0)
        return F.when(F.count("v").over(frame) >= 10, F.avg("v").over(frame))

    expected = df.withColumns(
        {"m": mean(336), "d": mean(48), "l1": F.lag("v", 1).over(w), "l336": F.lag("v", 336).over(w)}
    )
    columns = ["k", "t", "v", "m", "d", "l1", "l336"]
    a, b = (x.select(columns).toPandas().sort_values(["k", "t"]).reset_index(drop=True) for x in (got, expected))
    pd.testing.assert_frame_equal(a, b, check_dtype=False)


@pytest.mark.parametrize("chunk_rows", [100, 20000])
def test_row_index_equals_row_number(spark, chunk_rows):
    df = random_series(spark)
    w = Window.partitionBy("k").orderBy("t")
    wrong = (
        row_index(df, "t", ["k"], chunk_rows=chunk_rows)
        .withColumn("expected", F.row_number().over(w) - 1)
        .filter("row_no <> expected")
    )
    assert wrong.count() == 0


def test_duplicates_and_intervals(spark):
    df = spark.createDataFrame([(period(i),) for i in (0, 1, 1, 2, 4, 5)], "settlement_period timestamp")
    assert [r["copies"] for r in duplicate_times(df, "settlement_period").collect()] == [2]
    # the repeated time is 0 minutes from its copy; 4 follows 2
    assert irregular_intervals(df, "settlement_period", chunk_rows=2).count() == 2


def test_short_series_keep_one_shuffle(spark):
    """Series that fit a task are windowed whole: no join, one exchange by series."""
    df = spark.range(9000).select(
        (F.col("id") % 90).alias("k"), F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 1800).alias("t"), F.col("id").alias("v")
    )
    got = add_windows(df, "t", ["k"], means={"m": "v"}, lags={"l": ("v", 1)})
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_full_bucket_is_split_further(spark):
    """A third of all rows in one day of one series: narrower buckets are used, results stay."""
    df = spark.range(9000).select(
        (F.col("id") % 3).alias("k"),
        F.timestamp_millis(F.lit(1704067200000) + F.when(F.col("id") % 3 == 0, F.col("id") * 500).otherwise(F.col("id") * 1800000)).alias("t"),
        F.col("id").alias("v"),
    )
    chunked = cut(df, ["k"], "t", before=10, chunk_rows=100)
    assert chunked.frame.filter("k = 0").groupBy("_chunk").count().agg(F.max("count")).first()[0] < 500
    w = Window.partitionBy("k").orderBy("t")
    got = lag_columns(df, ["v"], "t", ["k"], [10], chunk_rows=100)
    expected = df.withColumn("v_lag_10", F.lag("v", 10).over(w))
    assert got.exceptAll(expected).count() == 0 and got.count() == 9000


def test_hot_series_is_spread_over_chunks(spark):
    df = spark.range(40000).select(
        F.lit(1).alias("k"), F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 1800).alias("t"), F.col("id").alias("v")
    )
    chunked = cut(df, ["k"], "t", before=335, chunk_rows=5000)
    sizes = [r["count"] for r in chunked.frame.groupBy("_chunk").count().collect()]
    assert len(sizes) == 8
    week = 336  # rows of one bucket, by which chunk and halo are rounded up
    assert max(sizes) <= 5000 + 335 + 2 * week
    assert chunked.home_rows().count() == 40000


def test_rolling_mean_forgets_values_that_left_the_window(spark):
    import math

    rows = [(i, 1e17 if i == 0 else float("inf") if i == 1200 else float("nan") if i == 2400 else 1.5) for i in range(3600)]
    df = spark.createDataFrame([(period(i), v, "a") for i, v in rows], "ts timestamp, x double, k string")
    for chunk_rows in (50_000, 700, 336):
        got = [r.m for r in add_windows(df, "ts", ["k"], means={"m": "x"}, chunk_rows=chunk_rows).orderBy("ts").collect()]
        for odd, bad in ((0, lambda v: v > 1e13), (1200, math.isinf), (2400, math.isnan)):
            assert all(bad(v) for v in got[odd : odd + 336])
            assert got[odd + 336 : odd + 1200] == [1.5] * 864


def test_a_chunk_is_never_shorter_than_the_reach(spark):
    df = spark.createDataFrame([(period(i), float(i)) for i in range(900)], "ts timestamp, x double")
    got = [r.m for r in add_windows(df, "ts", means={"m": "x"}, chunk_rows=50).orderBy("ts").collect()]
    assert got == [sum(range(max(0, i - 335), i + 1)) / min(i + 1, 336) for i in range(900)]
