"""Features kept up to date as readings arrive, and a batch window for forecasts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattline.functions.columns import join_null_safe
from wattline.functions.reference import DAY_PERIODS, LAGS, WEEK_PERIODS
from wattline.operators.charging import optimise_sessions
from wattline.operators.features import add_calendar
from wattline.operators.windows import add_windows
from wattline.plans.medallion import gold_carbon
from wattline.streaming.runner import latest_rows, read_batches, write_batch

TS = "settlement_period"
DAY = "reading_day"


def online_features(readings: DataFrame, keys: list[str], weather: DataFrame | None = None) -> DataFrame:
    """Seven-day wind and solar means, 24-hour carbon mean, carbon lags, calendar, weather."""
    df = add_windows(
        readings,
        TS,
        keys,
        means={
            "wind_7d_avg": ("wind", WEEK_PERIODS),
            "solar_7d_avg": ("solar", WEEK_PERIODS),
            "carbon_24h_avg": ("carbon_intensity", DAY_PERIODS),
        },
        lags={f"lag_{n}": ("carbon_intensity", n) for n in LAGS},
    )
    if weather is not None:
        df = df.join(weather, [*keys, TS], "left")
    return add_calendar(df, TS)


def _enough_history(readings: DataFrame, touched: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """Latest readings, from far enough back to hold ``rows`` rows before every touched series.

    The store is partitioned by day, so each try reads only recent days; the reach doubles until
    no series is short of rows or the store has nothing older.
    """
    first_day = touched.agg(F.min(F.to_date("_from"))).first()[0]
    oldest = readings.agg(F.min(DAY)).first()[0]
    days = 8
    while True:
        since = first_day - dt.timedelta(days=days)
        recent = latest_rows(readings.filter(F.col(DAY) >= F.lit(since)), [*keys, TS])
        if since <= oldest:
            return recent
        before = join_null_safe(touched, recent.select(*keys, TS), keys, "left")
        seen = F.sum(F.coalesce((F.col(TS) < F.col("_from")).cast("int"), F.lit(0)))
        if not before.groupBy(*keys).agg(seen.alias("_n")).filter(F.col("_n") < rows).head(1):
            return recent
        days *= 2


def feature_handler(
    spark: SparkSession, readings_path: str, features_path: str, keys: list[str], weather: DataFrame | None = None
) -> Callable[[DataFrame, int], None]:
    """Micro-batch handler: store the readings, then redo the features they change.

    A reading changes its own row and, as windows count rows, the later rows of its series. The
    history comes from the stored readings, not from stream state.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch.withColumn(DAY, F.to_date(TS)), readings_path, batch_id, [DAY])
        mine = spark.read.parquet(f"{readings_path}/batch_id={batch_id}")
        touched = mine.groupBy(*keys).agg(F.min(TS).alias("_from"))
        stored = read_batches(spark, readings_path)
        history = _enough_history(stored, touched, keys, max(WEEK_PERIODS, *LAGS))
        of_touched = join_null_safe(history.drop(DAY), touched, keys)
        wanted = online_features(of_touched, keys, weather).filter(F.col(TS) >= F.col("_from")).drop("_from")
        write_batch(wanted, features_path, batch_id)

    return handle


def schedule_handler(path: str, forecast: Callable[[], DataFrame], max_rate_kw: float) -> Callable[[DataFrame, int], None]:
    """Micro-batch handler: schedule new sessions against the latest forecast."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch(optimise_sessions(batch, forecast(), max_rate_kw), path, batch_id)

    return handle


def forecast_window(readings: DataFrame, start, end, history: str = "14 days") -> DataFrame:
    """Feature rows of [start, end) with their full history: lags count rows, so it reaches back over
    ``history`` and, for a series with gaps, as many days further as hold the rows of its longest lag."""
    lo, hi = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    first = F.date_trunc("day", lo - F.expr(f"INTERVAL {history}"))
    days = readings.filter(F.col(TS) < lo).groupBy("region_id", F.date_trunc("day", TS).alias("_day")).agg(F.count("*").alias("_n"))
    later = Window.partitionBy("region_id").orderBy(F.desc("_day")).rowsBetween(Window.unboundedPreceding, -1)
    # Days are needed as long as the later ones hold fewer rows than the longest lag.
    needed = days.withColumn("_later", F.coalesce(F.sum("_n").over(later), F.lit(0))).filter(F.col("_later") < WEEK_PERIODS)
    reach = needed.groupBy("region_id").agg(F.least(F.min("_day"), first).alias("_from"))
    known = join_null_safe(readings.filter(F.col(TS) < hi), reach, ["region_id"], "left")
    span = known.filter(F.col(TS) >= F.coalesce("_from", first)).drop("_from")
    return gold_carbon(span).filter(F.col(TS) >= lo)
