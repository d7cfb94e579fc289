"""Row-offset windows over time series: rolling means, lags, intervals, duplicates, row index.

All work on any number of series (``keys`` may be empty) and of any length, see ``chunks``.
Offsets count rows, not time: after long gaps were dropped, 48 rows may span over a day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from wattline.functions.columns import step_micros
from wattline.functions.reference import LAGS, SETTLEMENT_STEP, WEEK_PERIODS
from wattline.operators.chunks import CHUNK_ROWS, Chunked, cut


def _sums(source: str, w: WindowSpec) -> Column:
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    return F.struct(F.coalesce(F.sum(source).over(upto).cast("double"), F.lit(0.0)).alias("sum"), F.count(source).over(upto).alias("n"))


def _block_sums(chunked: Chunked, spans: dict[str, tuple[str, int]], min_periods: int) -> Chunked:
    """Rolling means from blocks as long as the window.

    A window is the end of one block and the start of the next, so its sum is one addition of a sum
    from a row to its block's end and one from a block's start to a row. Nothing outside the window
    is ever added or taken away: a huge or infinite value leaves no trace behind it.
    """
    chunk = [*chunked.keys, "_chunk"]
    chunked = chunked.with_columns({"_row": F.row_number().over(chunked.window()) - 1})
    for rows in sorted({n for _, n in spans.values()}):
        sources = sorted({src for src, n in spans.values() if n == rows})
        chunked = chunked.with_columns({"_block": F.floor(F.col("_row") / rows)})
        block = Window.partitionBy(*chunk, "_block")
        chunked = chunked.with_columns({f"_from_start_{c}": _sums(c, block.orderBy("_row")) for c in sources})
        chunked = chunked.with_columns({f"_to_end_{c}": _sums(c, block.orderBy(F.desc("_row"))) for c in sources})
        order = Window.partitionBy(*chunk).orderBy("_row")
        whole = F.col("_row") % rows == rows - 1
        out: dict[str, Column] = {}
        for new, (src, n) in spans.items():
            if n == rows:
                before = F.when(~whole, F.lag(f"_to_end_{src}", rows - 1).over(order))
                total = F.col(f"_from_start_{src}.sum") + F.coalesce(before["sum"], F.lit(0.0))
                count = F.col(f"_from_start_{src}.n") + F.coalesce(before["n"], F.lit(0))
                out[new] = F.when(count >= max(min_periods, 1), total / count)
        chunked = chunked.with_columns(out)
    return chunked


def add_windows(
    df: DataFrame,
    ts: str,
    keys: list[str] = (),
    means: dict[str, str | tuple[str, int]] | None = None,
    lags: dict[str, tuple[str, int]] | None = None,
    window_rows: int = WEEK_PERIODS,
    min_periods: int = 1,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Rolling means and lags in one pass: ``means`` {new: source or (source, rows)}, ``lags`` {new: (source, n)}.

    The cost of a rolling mean does not grow with the window, see ``_block_sums``. It is null with
    fewer than ``min_periods`` values in the window.
    """
    lags, keys = lags or {}, list(keys)
    spans = {new: src if isinstance(src, tuple) else (src, window_rows) for new, src in (means or {}).items()}
    reach = max([n - 1 for _, n in spans.values()] + [n for _, n in lags.values()] + [0])
    chunked = cut(df, keys, ts, before=reach, chunk_rows=chunk_rows)
    w = chunked.window()
    shifted = chunked.with_columns({new: F.lag(src, n).over(w) for new, (src, n) in lags.items()}) if lags else chunked
    return (_block_sums(shifted, spans, min_periods) if spans else shifted).home_rows()


def rolling_mean(df, columns, ts, keys=(), window_rows=WEEK_PERIODS, min_periods=1, suffix="_7d_avg", **kw):
    """``{c}{suffix}`` for each column that is present."""
    means = {f"{c}{suffix}": c for c in columns if c in df.columns}
    return add_windows(df, ts, keys, means=means, window_rows=window_rows, min_periods=min_periods, **kw)


def lag_columns(df, columns, ts, keys=(), offsets=LAGS, **kw):
    """``{c}_lag_{n}`` for each column that is present and each offset."""
    lags = {f"{c}_lag_{n}": (c, n) for c in columns if c in df.columns for n in offsets}
    return add_windows(df, ts, keys, lags=lags, **kw)


def irregular_intervals(df: DataFrame, ts: str, keys: list[str] = (), step: str = SETTLEMENT_STEP, **kw) -> DataFrame:
    """Rows (keys, ts, previous) whose distance to the previous row is not ``step``."""
    chunked = cut(df.filter(F.col(ts).isNotNull()).select(*keys, ts), list(keys), ts, before=1, **kw)
    rows = chunked.with_columns({"previous": F.lag(ts, 1).over(chunked.window())}).home_rows()
    return rows.filter(F.unix_micros(ts) - F.unix_micros("previous") != step_micros(step))


def duplicate_times(df: DataFrame, ts: str, keys: list[str] = ()) -> DataFrame:
    """(keys, ts, copies) for every time that occurs more than once."""
    return (
        df.filter(F.col(ts).isNotNull())
        .groupBy(*keys, ts)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
    )


def row_index(df: DataFrame, ts: str, keys: list[str] = (), index: str = "row_no", total: str = "series_rows", **kw):
    """Position of each row in its series, from 0, and the length of the series."""
    chunked: Chunked = cut(df, list(keys), ts, **kw)
    numbered = chunked.with_columns(
        {
            index: F.col("_offset") + F.row_number().over(chunked.window()) - 1,
            total: chunked.series_rows(),
        }
    )
    return numbered.home_rows()
