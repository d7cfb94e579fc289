"""Flatten API payloads: a text column of JSON in, typed rows out.

Leaf values are read as text and cast with ``try_cast``, so one bad number gives a null and
not a lost payload. Every function is one narrow pass: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions.reference import FUELS, WEATHER_PAYLOAD_FIELDS, WEATHER_VARS

# Time patterns of the feeds.
PERIOD_PATTERNS = ["yyyy-MM-dd'T'HH:mmX", "yyyy-MM-dd'T'HH:mm:ssX"]
HOUR_PATTERNS = ["yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd'T'HH:mm:ss"]

_INTENSITY = "struct<forecast:string,actual:string,index:string>"
_MIX = "array<struct<fuel:string,perc:string>>"
_REGION = f"struct<regionid:string,dnoregion:string,shortname:string,intensity:{_INTENSITY},generationmix:{_MIX}>"


def parse_time(text: Column, patterns: list[str]) -> Column:
    """First pattern that fits, else null."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(p)) for p in patterns])


def to_number(text: Column) -> Column:
    """A finite number, else null."""
    value = text.try_cast("double")
    return F.when(F.isnan(value), None).otherwise(value)


def to_whole(text: Column) -> Column:
    return to_number(text).try_cast("long")


def _entries(payloads: DataFrame, column: str, entry: str, keep: list[str] = ()) -> DataFrame:
    parsed = F.from_json(F.col(column), f"struct<data:array<struct<{entry}>>>")
    return payloads.select(*keep, F.explode(parsed["data"]).alias("e"))


def flatten_intensity(payloads: DataFrame, column: str = "value") -> DataFrame:
    """(settlement_period, intensity_actual, intensity_forecast) of national payloads."""
    rows = _entries(payloads, column, f"from:string,intensity:{_INTENSITY}")
    return rows.select(
        parse_time(F.col("e.from"), PERIOD_PATTERNS).alias("settlement_period"),
        to_whole(F.col("e.intensity.actual")).try_cast("int").alias("intensity_actual"),
        to_whole(F.col("e.intensity.forecast")).try_cast("int").alias("intensity_forecast"),
    )


def _region_rows(payloads: DataFrame, column: str) -> DataFrame:
    rows = _entries(payloads, column, f"from:string,to:string,regions:array<{_REGION}>")
    return rows.select(
        parse_time(F.col("e.from"), PERIOD_PATTERNS).alias("period_from"),
        parse_time(F.col("e.to"), PERIOD_PATTERNS).alias("period_to"),
        F.explode("e.regions").alias("r"),
    )


def flatten_regional_intensity(payloads: DataFrame, column: str = "value") -> DataFrame:
    """One row per period and region; carbon_intensity is the forecast, never the actual."""
    return _region_rows(payloads, column).select(
        "period_from",
        "period_to",
        to_whole(F.col("r.regionid")).alias("region_id"),
        F.col("r.dnoregion").alias("dno_region_name"),
        F.col("r.shortname").alias("region_name"),
        to_whole(F.col("r.intensity.forecast")).alias("carbon_intensity"),
        F.col("r.intensity.index").alias("intensity_index"),
    )


def _fuel_columns(mix: str) -> list[Column]:
    """A column per known fuel: the last entry wins, a fuel not listed is null."""
    return [
        to_number(F.expr(f"try_element_at(filter({mix}, m -> m.fuel = '{fuel}'), -1).perc")).alias(fuel)
        for fuel in FUELS
    ]


def flatten_generation_mix(payloads: DataFrame, column: str = "value") -> DataFrame:
    """(settlement_period, nine fuels) of national payloads."""
    rows = _entries(payloads, column, f"from:string,generationmix:{_MIX}")
    return rows.select(
        parse_time(F.col("e.from"), PERIOD_PATTERNS).alias("settlement_period"), *_fuel_columns("e.generationmix")
    )


def flatten_regional_mix(payloads: DataFrame, column: str = "value") -> DataFrame:
    """(region_id, settlement_period, nine fuels) of regional payloads."""
    return _region_rows(payloads, column).select(
        to_whole(F.col("r.regionid")).alias("region_id"),
        F.col("period_from").alias("settlement_period"),
        *_fuel_columns("r.generationmix"),
    )


def flatten_weather(payloads: DataFrame, entity: list[str], column: str = "value") -> DataFrame:
    """One row per time of the parallel arrays; arrays shorter than ``time`` give nulls.

    ``entity`` names the columns beside the payload that say whose weather it is.
    """
    fields = ",".join(f"{f}:array<string>" for f in ["time", *WEATHER_PAYLOAD_FIELDS.values()])
    parsed = F.from_json(F.col(column), f"struct<hourly:struct<{fields}>>")
    rows = payloads.select(*entity, parsed["hourly"].alias("h")).select(*entity, "h", F.posexplode("h.time").alias("i", "t"))
    return rows.select(
        *entity,
        parse_time(F.col("t"), HOUR_PATTERNS).alias("timestamp"),
        *[to_number(F.get(F.col(f"h.{WEATHER_PAYLOAD_FIELDS[v]}"), F.col("i"))).alias(v) for v in WEATHER_VARS],
    )
