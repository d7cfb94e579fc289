"""Which time ranges still have to be fetched, and in what chunks."""

from __future__ import annotations

import datetime as dt
import logging

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, SparkRuntimeException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _instant(value) -> Column:
    """A literal time; one without a zone is UTC."""
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime) and value.tzinfo is None:
        value = value.replace(tzinfo=dt.timezone.utc)
    return F.lit(value).cast("timestamp")


def missing_ranges(
    held: DataFrame,
    start,
    end,
    ts: str = "settlement_period",
    keys: list[str] = (),
    series: DataFrame | None = None,
) -> DataFrame:
    """(keys, range_start, range_end): what lies before and after the data held.

    Holes inside the data are not looked for. Without keys, no data gives the whole range; so does a
    series of ``series`` (a table of keys) without data.
    """
    lo, hi = _instant(start), _instant(end)
    seen = held.groupBy(*keys).agg(F.min(ts).alias("_min"), F.max(ts).alias("_max"))
    if series is not None:
        listed = series.select(*keys).distinct().withColumns({c: F.lit(None).cast("timestamp") for c in ("_min", "_max")})
        seen = seen.unionByName(listed).groupBy(*keys).agg(F.max("_min").alias("_min"), F.max("_max").alias("_max"))
    ranges = F.array(
        F.struct(lo.alias("range_start"), F.coalesce(F.col("_min"), hi).alias("range_end")),
        F.struct(F.col("_max").alias("range_start"), hi.alias("range_end")),
    )
    return seen.select(*keys, F.inline(ranges)).filter("range_start < range_end")


def missing_ranges_in_file(spark: SparkSession, path: str, start, end, ts: str = "settlement_period") -> DataFrame:
    """As above for a Parquet path; one that cannot be read counts as holding nothing."""
    try:
        held = spark.read.parquet(path).select(F.col(ts).cast("timestamp").alias(ts))
        # The two times that matter, read here, where a broken file can still be seen.
        extent = held.agg(F.min(ts).alias("a"), F.max(ts).alias("b")).select(F.explode(F.array("a", "b")).alias(ts))
        rows = extent.collect()
        held = spark.createDataFrame(rows, f"`{ts}` timestamp")
    except (AnalysisException, Py4JJavaError, SparkRuntimeException) as broken:
        logging.getLogger(__name__).warning("%s counts as holding nothing: %s", path, type(broken).__name__)
        held = spark.createDataFrame([], f"`{ts}` timestamp")
    return missing_ranges(held, start, end, ts)


def forward_chunks(spans: DataFrame, start: str, end: str, days: int, keys: list[str] = ()) -> DataFrame:
    """(keys, chunk_start, chunk_end): from the start, the last chunk clipped to the end."""
    step = F.make_dt_interval(F.lit(days))
    cursors = F.when(F.col(start) < F.col(end), F.sequence(F.col(start), F.col(end), step))
    return (
        spans.withColumn("chunk_start", F.explode(cursors))
        .filter(F.col("chunk_start") < F.col(end))
        .select(*keys, "chunk_start", F.least(F.col("chunk_start") + step, F.col(end)).alias("chunk_end"))
    )


def backward_chunks(spans: DataFrame, start: str, end: str, days: int, keys: list[str] = ()) -> DataFrame:
    """Chunks counted back from the end, whole days only: a part of a day at the start is left out."""
    micros_per_day = 86_400_000_000
    whole_days = F.floor((F.unix_micros(end) - F.unix_micros(start)) / micros_per_day).cast("int")
    per_span = spans.withColumn("_days", whole_days)
    numbers = F.when(F.col("_days") > 0, F.sequence(F.lit(0), F.col("_days") - 1, F.lit(days)))

    def before_end(n: Column) -> Column:
        return F.timestamp_micros(F.unix_micros(end) - n.cast("long") * micros_per_day)

    return per_span.withColumn("_done", F.explode(numbers)).select(
        *keys,
        before_end(F.least(F.col("_done") + days, F.col("_days"))).alias("chunk_start"),
        before_end(F.col("_done")).alias("chunk_end"),
    )
