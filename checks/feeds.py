"""Feeds and tables: payloads, CSV files, ranges, write rules."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.common import Tables, r, sql
from wattline.functions.reference import WEATHER_PAYLOAD_FIELDS, WEATHER_VARS
from wattline.plans import medallion
from wattline.session import work_path
from wattline.sources import bindings, files, payloads, ranges, tables

MIX_FUELS = ["wind", "gas", "nuclear", "solar"]


def _iso(column: str):
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm'Z'")


def _period(start: str):
    end = F.col(start) + F.expr("INTERVAL 30 MINUTES")
    return [_iso(start).alias("from"), F.date_format(end, "yyyy-MM-dd'T'HH:mm'Z'").alias("to")]


def _payload(df: DataFrame, entry, keep=()) -> DataFrame:
    return df.select(*keep, F.to_json(F.struct(F.array(entry).alias("data"))).alias("value"))


def intensity_payloads(t: Tables) -> DataFrame:
    intensity = F.struct(
        F.col("intensity_forecast").alias("forecast"),
        F.when(F.col("intensity_actual") % 7 > 0, F.col("intensity_actual")).alias("actual"),
        F.lit("moderate").alias("index"),
    )
    return _payload(t.carbon, F.struct(*_period("settlement_period"), intensity.alias("intensity")))


def _mix(fuels: list[str]):
    return F.array(
        *[F.struct(F.lit(f).alias("fuel"), F.col(f).alias("perc")) for f in fuels],
        F.struct(F.lit("tidal").alias("fuel"), F.lit(1.0).alias("perc")),
    ).alias("generationmix")


def mix_payloads(t: Tables) -> DataFrame:
    return _payload(t.generation, F.struct(*_period("settlement_period"), _mix(MIX_FUELS)))


def regional_payloads(t: Tables) -> DataFrame:
    """One payload per period with its regions, of which there are 14 at most."""
    mix = bindings.generation(t.events, keys={"region_id": F.col("user_id") % 14 + 1})
    bronze = t.regional_bronze.withColumnRenamed("period_from", "settlement_period")
    both = bronze.join(mix, ["region_id", "settlement_period"])
    region = F.struct(
        F.col("region_id").alias("regionid"),
        F.col("dno_region_name").alias("dnoregion"),
        F.col("region_name").alias("shortname"),
        F.struct(F.col("carbon_intensity").alias("forecast"), F.col("intensity_index").alias("index")).alias("intensity"),
        _mix(MIX_FUELS),
    )
    periods = both.groupBy("settlement_period").agg(F.collect_list(region).alias("regions"))
    return _payload(periods, F.struct(*_period("settlement_period"), "regions"))


def weather_payloads(t: Tables) -> DataFrame:
    """One payload per city and day: parallel arrays of at most 24 hours."""
    hour = F.struct("timestamp", *WEATHER_VARS)
    days = t.weather.groupBy("city", F.to_date("timestamp").alias("day")).agg(F.array_sort(F.collect_list(hour)).alias("h"))
    arrays = [F.expr("transform(h, x -> date_format(x.timestamp, \"yyyy-MM-dd'T'HH:mm\"))").alias("time")]
    arrays += [F.col(f"h.{v}").alias(WEATHER_PAYLOAD_FIELDS[v]) for v in WEATHER_VARS]
    return days.select("city", F.to_json(F.struct(F.struct(*arrays).alias("hourly"))).alias("value"))


def flatten_intensity(t: Tables):
    return payloads.flatten_intensity(intensity_payloads(t))


def flatten_regional(t: Tables):
    return payloads.flatten_regional_intensity(regional_payloads(t))


def flatten_mix(t: Tables):
    return payloads.flatten_generation_mix(mix_payloads(t))


def regional_mix(t: Tables):
    return payloads.flatten_regional_mix(regional_payloads(t))


def flatten_weather(t: Tables):
    return payloads.flatten_weather(weather_payloads(t), ["city"])


def load_sessions_csv(t: Tables):
    """Times of odd stations as RFC 1123 text, the others as ISO text."""
    odd = F.substring_index("station_id", "_", -1).cast("int") % 2 == 1

    def text(c: str):
        rfc = F.concat(F.date_format(c, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))
        return F.when(odd, rfc).otherwise(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'"))

    path = work_path(t.spark, "sessions-csv")
    t.sessions.select(
        F.col("session_id").alias("sessionID"),
        F.col("station_id").alias("stationID"),
        text("arrival_time").alias("connectionTime"),
        text("departure_time").alias("disconnectTime"),
        F.col("energy_kwh").alias("kWhDelivered"),
    ).write.option("header", True).csv(path)
    return files.load_sessions(t.spark, path)


def missing_ranges(t: Tables):
    return ranges.missing_ranges(
        t.regional, F.to_timestamp(F.lit("2023-12-25")), F.to_timestamp(F.lit("2024-02-05")), keys=["region_id"]
    )


def _extents(t: Tables):
    return t.regional.groupBy("region_id").agg(F.min("settlement_period").alias("lo"), F.max("settlement_period").alias("hi"))


def chunk_ranges(t: Tables):
    return ranges.forward_chunks(_extents(t), "lo", "hi", 14, ["region_id"])


def chunk_ranges_backward(t: Tables):
    return ranges.backward_chunks(_extents(t), "lo", "hi", 7, ["region_id"])


KEYS = ["region_id", "settlement_period"]


def _first_batch(t: Tables):
    return t.regional.filter(F.dayofmonth("settlement_period") <= 20).withColumn("seq", F.lit(0))


def _second_batch(t: Tables):
    """Overlaps the first by five days, holds each row twice, and has other values."""
    late = t.regional.filter(F.dayofmonth("settlement_period") >= 15)
    return late.withColumn("seq", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn(
        "carbon_intensity", F.col("carbon_intensity") + F.col("seq") * 1000
    )


def upsert_first_wins(t: Tables):
    return tables.insert_or_ignore(_first_batch(t), _second_batch(t), KEYS, [F.col("seq")])


def merge_insert_only(t: Tables):
    """Two merges into a Parquet layer, read back."""
    path = work_path(t.spark, "merge-layer")
    for batch in (_first_batch(t), _second_batch(t)):
        tables.merge_into_path(t.spark, path, batch, KEYS, [F.col("seq")], time_key="settlement_period")
    return t.spark.read.parquet(path)


def append_last_wins(t: Tables):
    """Two appends to a table kept by day, read back."""
    path = work_path(t.spark, "days")
    for batch in (_first_batch(t), _second_batch(t)):
        tables.append_keep_last_days(t.spark, path, batch, KEYS, [F.col("seq")], "settlement_period")
    return tables.read_days(t.spark, path)


def feature_snapshot(t: Tables):
    """Features written for two run dates; the later one is read back."""
    base = work_path(t.spark, "snapshots")
    silver = medallion.silver_carbon(t.regional_bronze)
    tables.write_snapshot(medallion.gold_carbon(silver, lags=[1]), base, dt.date(2024, 1, 30))
    tables.write_snapshot(medallion.gold_carbon(silver), base, dt.date(2024, 1, 31))
    return tables.load_latest_snapshot(t.spark, base).drop("run_date")


def layer_overwrite(t: Tables):
    """A layer written, emptied, and reloaded through an insert-only merge."""
    path = work_path(t.spark, "layer")
    tables.overwrite_layer(t.regional_weather, path)
    tables.truncate_layer(t.spark, path)
    tables.merge_into_path(t.spark, path, t.regional_weather, ["region_id", "timestamp"], [F.col("region_name")])
    return t.spark.read.parquet(path)


_NO_FUELS = ", ".join(f"CAST(NULL AS DOUBLE) AS {f}" for f in ("coal", "hydro", "imports", "biomass", "other"))
_SECOND = """SELECT region_id, settlement_period, carbon_intensity + 1000 * seq AS carbon_intensity, seq FROM regional,
    (SELECT unnest([1, 2]) AS seq) WHERE day(settlement_period) >= 15"""
_FIRST_WINS = f"""SELECT region_id, settlement_period, carbon_intensity, 0 AS seq FROM regional WHERE day(settlement_period) <= 20
    UNION ALL SELECT * FROM ({_SECOND}) WHERE seq = 1 AND day(settlement_period) > 20"""

QUERIES = {
    "flatten_intensity": (
        flatten_intensity,
        sql(
            "carbon",
            """SELECT settlement_period, CASE WHEN intensity_actual % 7 > 0 THEN intensity_actual END AS intensity_actual,
            intensity_forecast FROM carbon""",
        ),
    ),
    "flatten_regional": (flatten_regional, sql("bronze", "SELECT * FROM bronze")),
    "flatten_mix": (
        flatten_mix,
        sql("generation", f"SELECT settlement_period, {', '.join(r(f, f) for f in MIX_FUELS)}, {_NO_FUELS} FROM generation"),
    ),
    "regional_mix": (
        regional_mix,
        sql(
            "ev",
            "SELECT region_id, slot AS settlement_period, "
            + ", ".join(
                r(f"sum(CASE WHEN event_type = '{k}' THEN cents END) / 100.0", f)
                for f, k in {"wind": "click", "gas": "error", "nuclear": "purchase", "solar": "signup"}.items()
            )
            + f", {_NO_FUELS} FROM ev GROUP BY 1, 2",
        ),
    ),
    "flatten_weather": (
        flatten_weather,
        sql("weather", f"SELECT city, timestamp, {', '.join(r(v, v) for v in WEATHER_VARS)} FROM weather"),
    ),
    "load_sessions_csv": (
        load_sessions_csv,
        sql(
            "sessions",
            f"""SELECT session_id, station_id, date_trunc('second', arrival_time) AS arrival_time,
            date_trunc('second', departure_time) AS departure_time, {r('energy_kwh', 'energy_kwh')} FROM sessions
            WHERE date_trunc('second', arrival_time) < date_trunc('second', departure_time)""",
        ),
    ),
    "missing_ranges": (
        missing_ranges,
        sql(
            "regional",
            """SELECT region_id, TIMESTAMP '2023-12-25' AS range_start, min(settlement_period) AS range_end FROM regional GROUP BY 1
            UNION ALL SELECT region_id, max(settlement_period), TIMESTAMP '2024-02-05' FROM regional GROUP BY 1""",
        ),
    ),
    "chunk_ranges": (
        chunk_ranges,
        sql(
            "regional",
            """SELECT region_id, c AS chunk_start, least(c + INTERVAL 14 DAY, hi) AS chunk_end FROM (SELECT region_id, hi,
            unnest(generate_series(lo, hi, INTERVAL 14 DAY)) AS c FROM (SELECT region_id, min(settlement_period) AS lo,
            max(settlement_period) AS hi FROM regional GROUP BY 1)) WHERE c < hi""",
        ),
    ),
    "chunk_ranges_backward": (
        chunk_ranges_backward,
        sql(
            "regional",
            """SELECT region_id, hi - INTERVAL 1 DAY * least(i + 7, days) AS chunk_start, hi - INTERVAL 1 DAY * i AS chunk_end
            FROM (SELECT region_id, hi, days, unnest(range(0, days, 7)) AS i FROM (SELECT region_id,
            max(settlement_period) AS hi, (epoch_us(max(settlement_period)) - epoch_us(min(settlement_period)))
            // 86400000000 AS days FROM regional GROUP BY 1))""",
        ),
    ),
    "upsert_first_wins": (upsert_first_wins, sql("regional", _FIRST_WINS)),
    "merge_insert_only": (merge_insert_only, sql("regional", _FIRST_WINS)),
    "append_last_wins": (
        append_last_wins,
        sql(
            "regional",
            f"""SELECT region_id, settlement_period, carbon_intensity, 0 AS seq FROM regional WHERE day(settlement_period) < 15
            UNION ALL SELECT * FROM ({_SECOND}) WHERE seq = 2""",
        ),
    ),
    "feature_snapshot": (
        feature_snapshot,
        sql(
            "gold",
            f"""SELECT settlement_period, region_id, dno_region_name, region_name, carbon_intensity, intensity_index,
            carbon_intensity_valid, contains_nulls, {r('rolling_avg_7day', 'rolling_avg_7day')}, lag_1, lag_2, lag_48, lag_336
            FROM gold""",
        ),
    ),
    "layer_overwrite": (
        layer_overwrite,
        sql(
            "regional_weather",
            f"SELECT region_id, region_name, timestamp, {', '.join(r(v, v) for v in WEATHER_VARS)} FROM regional_weather",
        ),
    ),
}
