"""Time grids and the three distinct ways of filling gaps on them.

* short runs of missing values are carried forward, longer runs stay missing;
* observations are joined onto a grid by time-weighted interpolation (or last value);
* a coarse series is repeated onto a finer grid from its last observed row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.functions.columns import floor_div, non_null_keys, step_micros
from wattline.functions.reference import MAX_FILL_GAP, SETTLEMENT_STEP
from wattline.operators.chunks import CHUNK_ROWS, bucket_of, cut, fitting_width

GRID_BLOCK = 4096
CARRY_BUCKET = "28 days"


def time_grid(bounds: DataFrame, keys: list[str], ts: str, low: str, high: str, step: str = SETTLEMENT_STEP):
    """(keys, ts, _idx): every step from ``low`` to ``high`` of each row of ``bounds``.

    The grid is built in blocks, spread over tasks before they are expanded, so one long span
    is neither one huge array nor one task.
    """
    width = step_micros(step)
    first = F.unix_micros(F.col(low))
    last_idx = floor_div(F.unix_micros(F.col(high)) - first, width)
    blocks = bounds.filter(F.col(low).isNotNull()).select(
        *keys,
        first.alias("_first"),
        last_idx.alias("_last_idx"),
        F.explode(F.sequence(F.lit(0).cast("long"), floor_div(last_idx, GRID_BLOCK))).alias("_block"),
    )
    blocks = blocks.repartition(*keys, "_block")
    expanded = blocks.select(
        *keys,
        "_first",
        F.explode(
            F.sequence(
                F.col("_block") * GRID_BLOCK,
                F.least(F.col("_last_idx"), F.col("_block") * GRID_BLOCK + (GRID_BLOCK - 1)),
            )
        ).alias("_idx"),
    )
    return expanded.select(*keys, F.timestamp_micros(F.col("_first") + F.col("_idx") * width).alias(ts), "_idx")


def ffill_short_runs(
    df: DataFrame,
    columns: list[str],
    keys: list[str] = (),
    index: str = "_idx",
    max_gap: int = MAX_FILL_GAP,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Fill runs of at most ``max_gap`` nulls from the value before; longer runs stay null.

    ``df`` is gap-free: ``index`` counts 0, 1, 2, … in each series. A run's length is known from
    ``max_gap`` rows either side, so chunks of the index need a halo of that size only.
    """
    keys = list(keys)
    idx, pos = F.col(index), F.pmod(F.col(index), F.lit(chunk_rows))
    home = floor_div(idx, chunk_rows)
    halo = max_gap + 1
    targets = F.array_compact(
        F.array(
            home,
            F.when((pos < halo) & (home > 0), home - 1),
            F.when(pos >= chunk_rows - halo, home + 1),
        )
    )
    rows = df.withColumn("_home_chunk", home).withColumn("_chunk", F.explode(targets))
    w = Window.partitionBy(*keys, "_chunk").orderBy(index)
    behind, ahead = w.rowsBetween(-max_gap, -1), w.rowsBetween(1, max_gap)

    def filled(c: str) -> Column:
        seen_at = F.when(F.col(c).isNotNull(), idx)
        previous = F.max(seen_at).over(behind)
        following = F.min(seen_at).over(ahead)
        run_end = F.coalesce(following - 1, F.max(index).over(ahead), idx)
        return F.when(F.col(c).isNotNull(), F.col(c)).when(
            run_end - previous <= max_gap, F.last(c, ignorenulls=True).over(behind)
        )

    out = rows.withColumns({f"_filled_{i}": filled(c) for i, c in enumerate(columns)})
    out = out.filter(F.col("_chunk") == F.col("_home_chunk"))
    position = {c: i for i, c in enumerate(columns)}
    return out.select(
        *[F.col(f"_filled_{position[c]}").alias(c) if c in position else F.col(c) for c in df.columns]
    )


def time_span(df: DataFrame, ts: str, keys: list[str] = ()) -> DataFrame:
    """(keys, _lo, _hi): first and last time of each series."""
    return df.groupBy(*keys).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))


def joint_span(frames: list[DataFrame], ts: str, keys: list[str] = ()) -> DataFrame:
    spans = [time_span(f.select(*keys, ts), ts, keys) for f in frames]
    return reduce(DataFrame.unionByName, spans).groupBy(*keys).agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))


def _nearest(
    grid: DataFrame,
    observed: DataFrame,
    keys: list[str],
    ts: str,
    columns: list[str],
    bucket: str,
    forward: bool,
    cover: DataFrame | None,
) -> DataFrame:
    """Grid and observed rows with ``_prev_{c}``, ``_next_{c}``: the nearest observation.

    Reach is unlimited, so what lies outside a row's bucket comes from a small table of each
    bucket's first and last observation, carried across buckets. ``cover`` bounds the grid's
    times per series; without it they are taken from the grid, which then runs twice.
    """
    names = {c: f"_obs_{i}" for i, c in enumerate(columns)}

    bucket = fitting_width(observed, keys, ts, bucket)
    series = list(non_null_keys(grid, keys))

    def marked(df: DataFrame, on_grid: bool) -> DataFrame:
        own = {"_on_grid": F.lit(on_grid), "_bucket": bucket_of(ts, bucket)}
        return df.withColumns({**own, **non_null_keys(df, keys)})

    seen = marked(observed.select(*keys, ts, *columns), False).withColumns(
        {names[c]: F.when(F.col(c).isNotNull(), F.struct(F.col(ts).alias("t"), F.col(c).alias("v"))) for c in columns}
    ).drop(*columns)
    rows = marked(grid, True).unionByName(seen, allowMissingColumns=True)
    if cover is None:
        cover = time_span(grid.select(*keys, ts), ts, keys)
    width = step_micros(bucket)
    covered = cover.filter(F.col("_lo").isNotNull()).select(
        *[c.alias(n) for n, c in non_null_keys(cover, keys).items()],
        F.explode(
            F.sequence(floor_div(F.unix_micros("_lo"), width), floor_div(F.unix_micros("_hi"), width))
        ).alias("_bucket"),
    )
    edges = seen.drop(*keys).unionByName(covered, allowMissingColumns=True).groupBy(*series, "_bucket").agg(
        *[F.max(names[c]).alias(f"_last_{i}") for i, c in enumerate(columns)],
        *([F.min(names[c]).alias(f"_first_{i}") for i, c in enumerate(columns)] if forward else []),
    )
    asc = Window.partitionBy(*series).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    desc = Window.partitionBy(*series).orderBy(F.col("_bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carry = edges.select(
        *series,
        "_bucket",
        *[F.last(f"_last_{i}", ignorenulls=True).over(asc).alias(f"_before_{i}") for i in range(len(columns))],
        *(
            [F.last(f"_first_{i}", ignorenulls=True).over(desc).alias(f"_after_{i}") for i in range(len(columns))]
            if forward
            else []
        ),
    )
    # The join and both windows below need the same partitioning, so the rows are shuffled once.
    joined = rows.join(carry, [*series, "_bucket"])
    part = Window.partitionBy(*series, "_bucket")
    # Observations sort before grid rows of the same time in both directions.
    back = part.orderBy(F.col(ts).asc(), F.col("_on_grid").asc()).rowsBetween(Window.unboundedPreceding, 0)
    fore = part.orderBy(F.col(ts).desc(), F.col("_on_grid").asc()).rowsBetween(Window.unboundedPreceding, 0)
    out = joined.withColumns(
        {
            f"_prev_{c}": F.coalesce(F.last(names[c], ignorenulls=True).over(back), F.col(f"_before_{i}"))
            for i, c in enumerate(columns)
        }
    )
    if forward:
        out = out.withColumns(
            {
                f"_next_{c}": F.coalesce(F.last(names[c], ignorenulls=True).over(fore), F.col(f"_after_{i}"))
                for i, c in enumerate(columns)
            }
        )
    return out


def interpolate_onto(
    grid: DataFrame,
    observed: DataFrame,
    columns: list[str],
    ts: str,
    keys: list[str] = (),
    extrapolate: bool = True,
    bucket: str = CARRY_BUCKET,
    cover: DataFrame | None = None,
) -> DataFrame:
    """``grid`` plus ``columns`` of ``observed`` at the grid times.

    Exact at an observation; time-weighted between two; null before the first; after the last
    the last value is held (null with ``extrapolate=False``). Nulls in a column are skipped.
    """
    keys, columns = list(keys), list(columns)
    near = _nearest(grid, observed, keys, ts, columns, bucket, True, cover)
    def value(c: str) -> Column:
        before, after, now = f"`_prev_{c}`", f"`_next_{c}`", f"`{ts}`"
        held = f"{before}.v" if extrapolate else "null"
        return F.expr(
            f"""CASE WHEN {before}.t = {now} THEN CAST({before}.v AS double)
                     WHEN {after} IS NULL THEN CAST({held} AS double)
                     ELSE {before}.v + (CAST({after}.v AS double) - {before}.v)
                          * (unix_micros({now}) - unix_micros({before}.t))
                          / nullif(unix_micros({after}.t) - unix_micros({before}.t), 0) END"""
        )

    return near.filter("_on_grid").select(*grid.columns, *[value(c).alias(c) for c in columns])


def carry_onto(
    grid: DataFrame,
    observed: DataFrame,
    columns: list[str],
    ts: str,
    keys: list[str] = (),
    backfill: bool = True,
    bucket: str = CARRY_BUCKET,
    cover: DataFrame | None = None,
) -> DataFrame:
    """``grid`` plus the last known value of each column; before the first one, the next value."""
    keys, columns = list(keys), list(columns)
    near = _nearest(grid, observed, keys, ts, columns, bucket, backfill, cover)

    def value(c: str) -> Column:
        previous = F.col(f"_prev_{c}.v")
        return F.coalesce(previous, F.col(f"_next_{c}.v")) if backfill else previous

    return near.filter("_on_grid").select(*grid.columns, *[value(c).alias(c) for c in columns])


def upsample_last_row(df: DataFrame, ts: str, keys: list[str] = (), step: str = SETTLEMENT_STEP, **kw) -> DataFrame:
    """Repeat each row on every grid time from its own up to the next row's, per series.

    Grid times are whole multiples of ``step``; the series ends at its last observation, and a
    null value of a row is carried as null.
    """
    keys, width = list(keys), step_micros(step)
    chunked = cut(df, keys, ts, after=1, **kw)
    rows = chunked.with_columns({"_next_ts": F.lead(ts, 1).over(chunked.window())}).frame.filter("_home")
    now = F.unix_micros(F.col(ts))
    first = F.negate(floor_div(F.negate(now), width))
    stop = F.when(F.col("_next_ts").isNull(), floor_div(now, width)).otherwise(
        floor_div(F.unix_micros(F.col("_next_ts")) - 1, width)
    )
    slots = F.when(stop >= first, F.sequence(first, stop))
    return rows.withColumn("_slot", F.explode(slots)).select(
        *[F.timestamp_micros(F.col("_slot") * width).alias(ts) if c == ts else F.col(c) for c in df.columns]
    )


def align(
    left: DataFrame,
    right: DataFrame,
    ts: str = "settlement_period",
    keys: list[str] = (),
    step: str = SETTLEMENT_STEP,
    max_gap: int = MAX_FILL_GAP,
    drop_incomplete: bool = True,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Both series on one gap-free grid from the earliest to the latest time of either.

    Rows off the grid are lost, short runs of nulls are filled, and rows with any null left are
    dropped. A time that occurs twice in one input is an error. Grid and inputs meet in one
    aggregation by (keys, time), which is one shuffle instead of two joins.
    """
    keys = list(keys)
    value_cols = {id(s): [c for c in s.columns if c not in (*keys, ts)] for s in (left, right)}
    left_cols, right_cols = value_cols[id(left)], value_cols[id(right)]
    bounds = joint_span([left, right], ts, keys)
    stacked = (
        time_grid(bounds, keys, ts, "_lo", "_hi", step)
        .unionByName(left.withColumn("_left", F.lit(1)), allowMissingColumns=True)
        .unionByName(right.withColumn("_right", F.lit(1)), allowMissingColumns=True)
    )
    copies = F.greatest(F.count("_left"), F.count("_right"))
    merged = (
        stacked.groupBy(*keys, ts)
        .agg(
            F.max("_idx").alias("_idx"),
            *[F.first(c, ignorenulls=True).alias(c) for c in (*left_cols, *right_cols)],
            copies.alias("_copies"),
        )
        .withColumn(
            "_idx",
            F.when(F.col("_copies") > 1, F.raise_error(F.lit(f"duplicate {ts} in an aligned series")).cast("long"))
            .otherwise(F.col("_idx")),
        )
        .filter(F.col("_idx").isNotNull())
    )
    filled = ffill_short_runs(
        merged.select(*keys, ts, "_idx", *left_cols, *right_cols),
        [*left_cols, *right_cols],
        keys,
        max_gap=max_gap,
        chunk_rows=chunk_rows,
    ).drop("_idx")
    return filled.dropna(subset=[ts, *left_cols, *right_cols]) if drop_incomplete else filled
