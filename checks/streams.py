"""Streams over files, run to their end; the stored result is returned."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import charging
from checks.common import CALENDAR_SQL, Tables, add_cte, r, sql
from wattline.operators.gaps import upsample_last_row
from wattline.session import work_path
from wattline.sources import bindings
from wattline.streaming import features, ingest, runner

KEYS = ["region_id"]
TS = "settlement_period"


def _stored(t: Tables, df, name: str) -> str:
    path = work_path(t.spark, name)
    df.write.parquet(path)
    return path


def _stream(t: Tables, df, name: str):
    path = _stored(t, df, name)
    return runner.file_stream(t.spark, path, t.spark.read.parquet(path).schema)


def _region():
    return (F.col("user_id") % 14 + 1).cast("long").alias("region_id")


def stream_dead_letter(t: Tables):
    """Events as JSON text; every seventh message is cut short."""
    message = F.to_json(F.struct("event_id", "ts", "value"))
    text = F.when(F.col("event_id") % 7 == 0, F.substring(message, 1, 30)).otherwise(message)
    path = work_path(t.spark, "topic")
    t.events.select(text.alias("value")).write.text(path)
    table, dead = work_path(t.spark, "good"), work_path(t.spark, "dead")
    stream = runner.file_stream(t.spark, path, "value string", "text")
    handle = ingest.dead_letter_handler("event_id long, ts timestamp, value double", ["event_id", "ts"], table, dead)
    runner.run_batches(stream, handle, work_path(t.spark, "checkpoint"))
    good = runner.read_batches(t.spark, table).select("event_id", F.lit("ok").alias("status"))
    bad = runner.read_batches(t.spark, dead).select(
        F.regexp_extract("raw", "\"event_id\":([0-9]+)", 1).cast("long").alias("event_id"), F.lit("dead").alias("status")
    )
    return good.unionByName(bad)


def stream_dedupe(t: Tables):
    """Each event is sent twice."""
    twice = t.events.select("event_id", "ts", "value", F.explode(F.array(F.lit(0), F.lit(1))).alias("copy")).drop("copy")
    path = work_path(t.spark, "deduped")
    stream = ingest.dedupe(_stream(t, twice, "twice"), ["event_id"], "ts")
    runner.run_batches(stream, runner.batch_writer(path), work_path(t.spark, "checkpoint"))
    return runner.read_batches(t.spark, path).drop("batch_id")


def _tumbling(t: Tables, files: int = 1):
    """Tumbling sums of readings that come as ``files`` files, a micro-batch each; the paths of sums and progress."""
    readings = t.events.select(_region(), "ts", F.round(F.col("value") * 100).cast("long").alias("cents"))
    source, path, log = (work_path(t.spark, n) for n in ("readings", "tumbling", "progress"))
    readings.repartition(files).write.parquet(source)
    stream = runner.file_stream(t.spark, source, readings.schema, files_per_batch=1)
    sums = ingest.tumbling(stream, "ts", {"n": F.count(F.lit(1)), "cents": F.sum("cents")}, KEYS)
    runner.run_batches(sums, runner.batch_writer(path), work_path(t.spark, "checkpoint"), "update", progress_path=log)
    return path, log


def stream_tumbling(t: Tables):
    path, _ = _tumbling(t)
    return runner.read_latest(t.spark, path, [*KEYS, TS])


def stream_progress(t: Tables):
    """Six files, six batches with rows: each is there once, and their input rows add up to the table."""
    _, log = _tumbling(t, 6)
    batches = runner.progress(t.spark, log).filter("input_rows > 0")
    return batches.agg(
        F.count(F.lit(1)).alias("n_batches"), F.sum("input_rows").alias("input_rows"),
        (F.count_distinct("batch_id") == F.count(F.lit(1))).alias("each_once"), (F.min("took_ms") >= 0).alias("timed"),
    )


def _readings(t: Tables):
    mix = bindings.generation(t.events, keys={"region_id": (F.col("user_id") % 14 + 1).cast("long")})
    return t.regional.join(mix.select(*KEYS, TS, "wind", "solar"), [*KEYS, TS])


def _period_weather(t: Tables):
    w = upsample_last_row(t.regional_weather, "timestamp", KEYS)
    return w.select("region_id", F.col("timestamp").alias(TS), "temperature", "wind_speed", "radiation")


def stream_features(t: Tables):
    """Readings in two micro-batches, the second for the later half of the month."""
    readings = _readings(t)
    path = work_path(t.spark, "feature-readings")
    weather = t.spark.read.parquet(_stored(t, _period_weather(t), "period-weather"))
    store, table, checkpoint = (work_path(t.spark, n) for n in ("store", "features", "checkpoint"))
    early = F.dayofmonth(TS) <= 15
    for half in (readings.filter(early), readings.filter(~early)):
        half.coalesce(1).write.mode("append").parquet(path)
        stream = runner.file_stream(t.spark, path, readings.schema)
        runner.run_batches(stream, features.feature_handler(t.spark, store, table, KEYS, weather), checkpoint)
    return runner.read_latest(t.spark, table, [*KEYS, TS])


def stream_join(t: Tables):
    mix = bindings.generation(t.events, keys={"region_id": (F.col("user_id") % 14 + 1).cast("long")})
    weather = t.regional_weather.select("region_id", "timestamp", "temperature")
    joined = ingest.join_feeds(
        _stream(t, t.regional, "carbon"), _stream(t, mix, "mix"), _stream(t, weather, "weather"), KEYS
    )
    path = work_path(t.spark, "joined")
    runner.run_batches(joined, runner.batch_writer(path), work_path(t.spark, "checkpoint"))
    return runner.read_batches(t.spark, path).drop("batch_id")


def stream_schedule(t: Tables):
    forecast = _stored(t, t.dense_regional, "forecast")
    path = work_path(t.spark, "schedules")
    handle = features.schedule_handler(path, lambda: t.spark.read.parquet(forecast), 7.0)
    runner.run_batches(_stream(t, t.sessions, "sessions"), handle, work_path(t.spark, "checkpoint"))
    return runner.read_latest(t.spark, path, ["session_id"])


def forecast_window(t: Tables):
    readings = t.dense_regional.withColumnRenamed("slot", TS).drop("price")
    return features.forecast_window(readings, "2024-01-20 00:00:00", "2024-01-22 00:00:00")


_MIX = ", ".join(
    f"CAST(sum(CASE WHEN event_type = '{k}' THEN cents END) AS DOUBLE) / 100 AS {f}"
    for f, k in {"wind": "click", "gas": "error", "nuclear": "purchase", "solar": "signup"}.items()
)
add_cte("region_mix", ["ev"], f"SELECT region_id, slot AS settlement_period, {_MIX} FROM ev GROUP BY 1, 2")
_W = "(PARTITION BY region_id ORDER BY settlement_period ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)"
_LAGS = ", ".join(
    f"lag(carbon_intensity, {n}) OVER (PARTITION BY region_id ORDER BY settlement_period) AS lag_{n}" for n in (1, 2, 48, 336)
)

QUERIES = {
    "stream_dead_letter": (
        stream_dead_letter,
        sql("ev", "SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'dead' ELSE 'ok' END AS status FROM ev"),
    ),
    "stream_dedupe": (stream_dedupe, sql("ev", f"SELECT event_id, ts, {r('value', 'value')} FROM ev")),
    "stream_tumbling": (
        stream_tumbling,
        sql(
            "ev",
            """SELECT region_id, slot AS settlement_period, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents
            FROM ev GROUP BY 1, 2""",
        ),
    ),
    "stream_progress": (
        stream_progress, sql("ev", "SELECT 6 AS n_batches, count(*) AS input_rows, TRUE AS each_once, TRUE AS timed FROM ev")
    ),
    "stream_features": (
        stream_features,
        sql(
            "regional region_mix half_hourly",
            f"""SELECT x.region_id, settlement_period, carbon_intensity, wind, solar, {r('wind_7d_avg', 'wind_7d_avg')},
            {r('solar_7d_avg', 'solar_7d_avg')}, {r('carbon_24h_avg', 'carbon_24h_avg')}, lag_1, lag_2, lag_48, lag_336,
            {r('h.temperature', 'temperature')}, {r('h.wind_speed', 'wind_speed')}, {r('h.radiation', 'radiation')},
            {CALENDAR_SQL} FROM (SELECT region_id, settlement_period, carbon_intensity, wind, solar,
            avg(wind) OVER {_W.format(n=335)} AS wind_7d_avg, avg(solar) OVER {_W.format(n=335)} AS solar_7d_avg,
            avg(carbon_intensity) OVER {_W.format(n=47)} AS carbon_24h_avg, {_LAGS}
            FROM regional JOIN region_mix USING (region_id, settlement_period)) x
            LEFT JOIN half_hourly h ON h.region_id = x.region_id AND h.timestamp = x.settlement_period""",
        ),
    ),
    "stream_join": (
        stream_join,
        sql(
            "regional region_mix regional_weather",
            f"""SELECT c.region_id, c.settlement_period, c.carbon_intensity, m.wind, m.gas, m.nuclear, m.solar,
            {r('w.temperature', 'temperature')} FROM regional c JOIN region_mix m USING (region_id, settlement_period)
            JOIN regional_weather w ON w.region_id = c.region_id AND w.timestamp = date_trunc('hour', c.settlement_period)""",
        ),
    ),
    "stream_schedule": (stream_schedule, charging.QUERIES["optimise_sessions"][1]),
    "forecast_window": (
        forecast_window,
        sql(
            "dense",
            f"""SELECT region_id, settlement_period, carbon_intensity, {r('m', 'rolling_avg_7day')}, lag_1, lag_2, lag_48,
            lag_336 FROM (SELECT region_id, settlement_period, carbon_intensity, avg(carbon_intensity) OVER
            {_W.format(n=335)} AS m, {_LAGS} FROM (SELECT *, slot AS settlement_period FROM dense)) WHERE settlement_period >=
            TIMESTAMP '2024-01-20' AND settlement_period < TIMESTAMP '2024-01-22'""",
        ),
    ),
}
