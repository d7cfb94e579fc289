"""Stream ingest: JSON topics with a dead-letter table, de-duplication, tumbling sums, joins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.functions.reference import SETTLEMENT_STEP
from wattline.streaming.runner import write_batch

BROKEN = "_broken"


def parse_topic(raw: DataFrame, schema: str, required: list[str], column: str = "value") -> DataFrame:
    """(raw text, parsed fields, ok): ok is false for unreadable JSON or a missing required field."""
    full = T.StructType([*T.StructType.fromDDL(schema).fields, T.StructField(BROKEN, T.StringType())])
    parsed = raw.select(
        F.col(column).alias("raw"),
        F.from_json(F.col(column), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}).alias("m"),
    )
    ok = F.col("m").isNotNull() & F.col(f"m.{BROKEN}").isNull()
    for name in required:
        ok = ok & F.col(f"m.{name}").isNotNull()
    return parsed.withColumn("ok", F.coalesce(ok, F.lit(False)))


def dead_letter_handler(
    schema: str, required: list[str], table: str, dead: str, column: str = "value"
) -> Callable[[DataFrame, int], None]:
    """Micro-batch handler: good messages to ``table``, the raw text of bad ones to ``dead``."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_topic(batch, schema, required, column).persist()
        good = parsed.filter("ok").select("m.*").drop(BROKEN)
        write_batch(good, table, batch_id)
        write_batch(parsed.filter("NOT ok").select("raw"), dead, batch_id)
        parsed.unpersist()

    return handle


def dedupe(stream: DataFrame, keys: list[str], ts: str, delay: str = "2 hours") -> DataFrame:
    """First message of each key; repeats within ``delay`` of event time are dropped."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def tumbling(
    stream: DataFrame, ts: str, aggregates: dict, keys: list[str] = (), width: str = SETTLEMENT_STEP, delay: str = "2 hours"
) -> DataFrame:
    """Aggregates {name: column} per window of ``width``; windows older than ``delay`` close."""
    return (
        stream.withWatermark(ts, delay)
        .groupBy(*keys, F.window(ts, width).alias("_window"))
        .agg(*[c.alias(n) for n, c in aggregates.items()])
        .select(*keys, F.col("_window.start").alias("settlement_period"), *aggregates)
    )


def join_feeds(carbon: DataFrame, generation: DataFrame, weather: DataFrame, keys: list[str], delay: str = "2 hours"):
    """Carbon and generation of the same period, with the weather of the hour it lies in.

    Each stream has a watermark and both joins bound event time, so state is released.
    """
    c = carbon.withWatermark("settlement_period", delay)
    g = generation.select(*[F.col(k).alias(f"_g_{k}") for k in [*keys, "settlement_period"]],
                          *[x for x in generation.columns if x not in (*keys, "settlement_period")])
    g = g.withWatermark("_g_settlement_period", delay)
    w = weather.select(*[F.col(k).alias(f"_w_{k}") for k in keys], F.col("timestamp").alias("_w_hour"),
                       *[x for x in weather.columns if x not in (*keys, "timestamp")])
    w = w.withWatermark("_w_hour", delay)
    same = F.col("settlement_period") == F.col("_g_settlement_period")
    in_hour = F.expr("settlement_period >= _w_hour AND settlement_period < _w_hour + INTERVAL 1 HOUR")
    for k in keys:
        same = same & (F.col(k) == F.col(f"_g_{k}"))
        in_hour = in_hour & (F.col(k) == F.col(f"_w_{k}"))
    joined = c.join(g, same).join(w, in_hour)
    return joined.drop("_w_hour", "_g_settlement_period", *[f"_{p}_{k}" for p in "gw" for k in keys])
