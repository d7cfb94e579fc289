"""Splitting long series into time chunks without changing row-offset windows.

A window over a series puts the series in one task. That is right for the many short series of
a fleet, and wrong for one that holds a large part of all rows. So the rows of each (series, time
bucket) are counted first, a small table. Series up to ``WHOLE`` chunks long keep their plain
window: one shuffle by series. A longer one is cut into chunks of about ``chunk_rows`` rows, and
each chunk also receives the few neighbouring rows (the halo) that its windows reach to; the
counts tell which buckets those are, whatever gaps the series has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from wattline.functions.columns import floor_div, join_null_safe, step_micros
from wattline.session import broadcast_if_small, settled

CHUNK_ROWS = 50_000
WHOLE = 4
BUCKET = "7 days"
NARROWER = ["1 day", "1 hour", "1 minute", "1 second"]


class Chunked:
    """Rows cut into chunks: ``frame`` holds home and halo rows, ``window`` spans one chunk."""

    def __init__(self, frame: DataFrame, keys: list[str], ts: str, inputs: list[str]):
        self.frame = frame
        self.keys = keys
        self.ts = ts
        self.inputs = inputs

    def window(self, descending: bool = False) -> WindowSpec:
        order = F.col(self.ts).desc() if descending else F.col(self.ts).asc()
        return Window.partitionBy(*self.keys, "_chunk").orderBy(order)

    def series_rows(self) -> Column:
        """Length of the row's series; a series that was not cut is its only chunk."""
        return F.coalesce(F.col("_series_rows"), F.count(F.lit(1)).over(Window.partitionBy(*self.keys, "_chunk")))

    def with_columns(self, columns: dict[str, Column]) -> "Chunked":
        return Chunked(self.frame.withColumns(columns), self.keys, self.ts, self.inputs)

    def home_rows(self) -> DataFrame:
        """Every input row once, without the helper columns."""
        helpers = [c for c in self.frame.columns if c.startswith("_") and c not in self.inputs]
        return self.frame.filter("_home").drop(*helpers)


def bucket_of(ts: str, width: str = BUCKET) -> Column:
    """Time bucket of a row; null times share the lowest bucket, as they sort first."""
    return F.coalesce(floor_div(F.unix_micros(F.col(ts)), step_micros(width)), F.lit(-(2**40)))


def widths_from(bucket: str) -> list[str]:
    """``bucket`` and the narrower widths to fall back on where a bucket is too full."""
    narrower = [w for w in NARROWER if step_micros(w) < step_micros(bucket)]
    return [bucket, *narrower]


def fitting_width(df: DataFrame, keys: list[str], ts: str, bucket: str, most_rows: int = WHOLE * CHUNK_ROWS) -> str:
    """The widest of those widths at which no (series, bucket) holds more than ``most_rows``."""
    for width in widths_from(bucket):
        if (bucket_counts(df, keys, ts, width).agg(F.max("_n")).first()[0] or 0) <= most_rows:
            break
    return width


def bucket_counts(df: DataFrame, keys: list[str], ts: str, bucket: str) -> DataFrame:
    """(keys, _bucket, _n): rows of each series in each time bucket."""
    return (
        df.select(*keys, bucket_of(ts, bucket).alias("_bucket"))
        .groupBy(*keys, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
    )


def chunk_plan(counts: DataFrame, keys: list[str], before: int, after: int, chunk_rows: int) -> DataFrame:
    """For each bucket of a long series: its home chunk, every chunk that needs its rows, offsets."""
    ordered = Window.partitionBy(*keys).orderBy("_bucket")
    plan = counts.withColumn("_end", F.sum("_n").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    plan = plan.withColumns(
        {"_start": F.col("_end") - F.col("_n"), "_series_rows": F.sum("_n").over(Window.partitionBy(*keys))}
    ).filter(F.col("_series_rows") > WHOLE * chunk_rows)
    plan = plan.withColumn("_home_chunk", floor_div(F.col("_start"), chunk_rows))
    targets = [F.array("_home_chunk")]
    if before:
        # Rows offsets _end .. _end+before-1 look back into this bucket; later buckets start
        # at _end or beyond, so their chunks lie between these two ids.
        last = F.least(F.col("_end") + F.lit(before), F.col("_series_rows")) - 1
        later = F.sequence(floor_div(F.col("_end"), chunk_rows), floor_div(last, chunk_rows))
        none = F.array().cast("array<bigint>")
        targets.append(F.coalesce(F.when(F.col("_end") < F.col("_series_rows"), later), none))
    if after:
        # Each bucket has a row, so only the ``after`` previous buckets can look this far ahead.
        earlier = [
            F.when(
                F.lag("_end", i).over(ordered) > F.col("_start") - F.lit(after),
                F.lag("_home_chunk", i).over(ordered),
            )
            for i in range(1, after + 1)
        ]
        targets.append(F.array_compact(F.array(*earlier)))
    return plan.select(
        *keys,
        "_bucket",
        "_home_chunk",
        F.array_distinct(F.concat(*targets)).alias("_chunks"),
        F.min("_start").over(Window.partitionBy(*keys, "_home_chunk")).alias("_offset"),
        "_series_rows",
    )


def cut(
    df: DataFrame,
    keys: list[str],
    ts: str,
    before: int = 0,
    after: int = 0,
    chunk_rows: int = CHUNK_ROWS,
    bucket: str = BUCKET,
) -> Chunked:
    """Cut each long series (``keys``, ordered by ``ts``) into chunks with the halo asked for.

    ``before``/``after`` are the rows a window reaches back/forward. ``bucket`` is the width rows are
    counted by; where one bucket would overfill a task, narrower ones are used.
    """
    chunk_rows = max(chunk_rows, before)  # a chunk is no shorter than the reach of its windows
    for width in widths_from(bucket):
        counts = settled(bucket_counts(df, keys, ts, width))
        per_series = counts.groupBy(*keys).agg(F.sum("_n").alias("_rows"), F.max("_n").alias("_fullest"))
        longest, fullest = per_series.agg(F.max("_rows"), F.max("_fullest")).first()
        if (longest or 0) <= WHOLE * chunk_rows or fullest <= WHOLE * chunk_rows:
            break
    if (longest or 0) <= WHOLE * chunk_rows:
        whole = {"_chunk": F.lit(0).cast("long"), "_home": F.lit(True), "_offset": F.lit(0).cast("long")}
        return Chunked(df.withColumns({**whole, "_series_rows": F.lit(None).cast("long")}), keys, ts, df.columns)
    plan = broadcast_if_small(chunk_plan(counts, keys, before, after, chunk_rows))
    rows = df.withColumn("_bucket", bucket_of(ts, width))
    joined = join_null_safe(rows, plan, [*keys, "_bucket"], "left").drop("_bucket")
    only = F.array(F.lit(0).cast("long"))
    frame = (
        joined.withColumn("_chunk", F.explode(F.coalesce("_chunks", only)))
        .withColumn("_home", F.coalesce(F.col("_chunk") == F.col("_home_chunk"), F.lit(True)))
        .withColumn("_offset", F.coalesce("_offset", F.lit(0).cast("long")))
    )
    return Chunked(frame.drop("_chunks", "_home_chunk"), keys, ts, df.columns)
