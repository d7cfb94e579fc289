"""The domain tables, shaped from an ``events`` table.

Sums are taken over whole cents, so results do not depend on the order of addition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.functions.columns import floor_div, step_micros
from wattline.functions.reference import SETTLEMENT_STEP
from wattline.operators.gaps import carry_onto, time_grid
from wattline.session import prepare

REGION_COUNT = 14


def _cents() -> Column:
    return F.round(F.col("value") * 100).cast("long")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _region() -> Column:
    return (F.col("user_id") % REGION_COUNT + 1).cast("long")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def slot(ts: str = "ts", step: str = SETTLEMENT_STEP) -> Column:
    width = step_micros(step)
    return F.timestamp_micros(floor_div(F.unix_micros(F.col(ts)), width) * width)


def _whole(numerator: Column, denominator: Column) -> Column:
    """Whole quotient of two non-negative longs."""
    return ((numerator - numerator % denominator) / denominator).cast("long")


def carbon(ev: DataFrame, step: str = SETTLEMENT_STEP) -> DataFrame:
    cents, n = F.sum(_cents()), F.count(F.lit(1))
    return (
        ev.filter(F.col("event_type") == "view")
        .groupBy(slot(step=step).alias("settlement_period"))
        .agg(
            F.least(F.lit(800), _whole(cents, 25 * n)).cast("int").alias("intensity_actual"),
            F.least(F.lit(800), _whole(F.max(_cents()), F.lit(25))).cast("int").alias("intensity_forecast"),
        )
    )


def generation(ev: DataFrame, step: str = SETTLEMENT_STEP, keys: dict[str, Column] | None = None) -> DataFrame:
    fuels = {"wind": "click", "gas": "error", "nuclear": "purchase", "solar": "signup"}
    keyed = [c.alias(n) for n, c in (keys or {}).items()]
    return ev.groupBy(*keyed, slot(step=step).alias("settlement_period")).agg(
        *[
            (F.sum(F.when(F.col("event_type") == kind, _cents())).cast("double") / 100).alias(fuel)
            for fuel, kind in fuels.items()
        ]
    )


def _weather(ev: DataFrame, **entity: Column) -> DataFrame:
    n = F.count(F.lit(1))
    hour = slot(step="1 hour").alias("timestamp")
    return ev.groupBy(*[c.alias(name) for name, c in entity.items()], hour).agg(
        (F.sum(_cents()).cast("double") / (1000 * n)).alias("temperature"),
        (F.sum(_k()).cast("double") / n).alias("wind_speed"),
        F.max("value").alias("radiation"),
    )


def weather(ev: DataFrame) -> DataFrame:
    third = F.col("user_id") % 3
    city = F.when(third == 0, "London").when(third == 1, "Manchester").otherwise("Edinburgh")
    return _weather(ev, city=city)


def regional_weather(ev: DataFrame) -> DataFrame:
    df = _weather(ev, region_id=_region())
    return df.withColumn("region_name", F.concat(F.lit("Region "), F.col("region_id").cast("string"))).select(
        "region_id", "region_name", "timestamp", "temperature", "wind_speed", "radiation"
    )


def regional(ev: DataFrame) -> DataFrame:
    return ev.groupBy(_region().alias("region_id"), slot().alias("settlement_period")).agg(
        _whole(F.sum(_cents()), 25 * F.count(F.lit(1))).alias("carbon_intensity")
    )


def regional_bronze(ev: DataFrame) -> DataFrame:
    """``regional`` in the raw layer's shape, with untrimmed names as a feed may send them."""
    rid = F.col("region_id").cast("string")
    half_hour = F.expr("INTERVAL 30 MINUTES")
    level = F.when(F.col("carbon_intensity") < 200, "low").when(F.col("carbon_intensity") < 400, "moderate").otherwise("high")
    return regional(ev).select(
        F.col("settlement_period").alias("period_from"),
        (F.col("settlement_period") + half_hour).alias("period_to"),
        "region_id",
        F.concat(F.lit(" DNO "), rid, F.lit(" ")).alias("dno_region_name"),
        F.concat(F.lit("Region "), rid, F.lit(" ")).alias("region_name"),
        "carbon_intensity",
        level.alias("intensity_index"),
    )


def sessions(ev: DataFrame) -> DataFrame:
    return ev.filter(F.col("event_type") == "purchase").select(
        F.concat(F.lit("sess_"), F.col("event_id").cast("string")).alias("session_id"),
        F.concat(F.lit("station_"), (F.col("user_id") % 20).cast("string")).alias("station_id"),
        _region().alias("region_id"),
        F.col("ts").alias("arrival_time"),
        F.timestamp_micros(F.unix_micros("ts") + (_k() - 2).cast("long") * step_micros("15 minutes")).alias("departure_time"),
        (F.col("value") / 4).alias("energy_kwh"),
    )


def dense_regional(ev: DataFrame) -> DataFrame:
    """Carbon for every region and slot (last known value, then the first one), with a price.

    (region_id, slot, carbon_intensity, price): the price in pence follows the carbon value.
    """
    observed = regional(ev)
    span = ev.agg(F.min(slot()).alias("_lo"), F.max(slot()).alias("_hi"))
    # One row of bounds for each of the fixed number of regions.
    bounds = span.withColumn("region_id", F.explode(F.expr(f"sequence(1L, {REGION_COUNT}L)")))
    grid = time_grid(bounds, ["region_id"], "settlement_period", "_lo", "_hi").drop("_idx")
    dense = carry_onto(grid, observed, ["carbon_intensity"], "settlement_period", ["region_id"], cover=bounds)
    return dense.select(
        "region_id",
        F.col("settlement_period").alias("slot"),
        "carbon_intensity",
        (F.col("carbon_intensity") % 32 + 4).cast("double").alias("price"),
    )
