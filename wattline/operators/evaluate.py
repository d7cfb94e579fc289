"""Forecast evaluation: losses, baselines, walk-forward folds, decision quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions.columns import join_null_safe
from wattline.functions.reference import DAY_PERIODS, WEEK_PERIODS
from wattline.operators.aggregates import exact_percentile
from wattline.operators.windows import add_windows, row_index
from wattline.session import broadcast_if_small


def pinball(actual: str, predicted: str, alpha: float | Column) -> Column:
    """Quantile loss of one row."""
    error = F.col(actual) - F.col(predicted)
    a = F.lit(alpha) if isinstance(alpha, (int, float)) else alpha
    return F.when(error >= 0, a * error).otherwise((a - 1) * error)


def error_metrics(df: DataFrame, actual: str, predicted: str, keys: list[str] = ()) -> DataFrame:
    """MAE, MSE, RMSE and MAPE (a fraction; rows with actual 0 have no percentage)."""
    error = (F.col(predicted) - F.col(actual)).cast("double")
    mse = F.avg(error * error)
    return df.groupBy(*keys).agg(
        F.avg(F.abs(error)).alias("mae"),
        mse.alias("mse"),
        F.sqrt(mse).alias("rmse"),
        F.avg(F.abs(F.try_divide(error, F.col(actual).cast("double")))).alias("mape"),
    )


def pinball_by_alpha(df: DataFrame, actual: str, predictions: dict[str, float], keys: list[str] = ()) -> DataFrame:
    """(keys, alpha, pinball_loss) for columns {prediction: alpha}; unpredicted rows are masked."""
    wide = df.groupBy(*keys).agg(
        *[
            F.struct(F.lit(a).alias("alpha"), F.avg(pinball(actual, c, a)).alias("pinball_loss")).alias(f"_a{i}")
            for i, (c, a) in enumerate(predictions.items())
        ]
    )
    return wide.select(*keys, F.inline(F.array(*[f"_a{i}" for i in range(len(predictions))])))


def quantile_crossing(df: DataFrame, p10: str, p50: str, p90: str, keys: list[str] = ()) -> DataFrame:
    """How many rows have their quantiles out of order, and what fraction of all rows."""
    crossed = F.coalesce((F.col(p10) > F.col(p50)) | (F.col(p50) > F.col(p90)), F.lit(False)).cast("int")
    return df.groupBy(*keys).agg(
        F.sum(crossed).alias("violation_count"), F.avg(crossed).alias("violation_pct")
    )


def _shifted(df: DataFrame, y: str, ts: str, keys: list[str], rows: int, name: str) -> DataFrame:
    marked = df.withColumn("row_exists", F.lit(True))
    lags = {name: (y, rows), "earlier_exists": ("row_exists", rows)}
    return add_windows(marked, ts, keys, lags=lags).filter("earlier_exists").drop("row_exists", "earlier_exists")


def persistence(df: DataFrame, y: str, ts: str, keys: list[str] = (), h: int = DAY_PERIODS, name: str = "persistence"):
    """The value ``h`` rows before; the first ``h`` rows of a series have none and are dropped."""
    return _shifted(df, y, ts, list(keys), h, name)


def seasonal_naive(
    df: DataFrame, y: str, ts: str, keys: list[str] = (), season: int = WEEK_PERIODS, name: str = "seasonal_naive"
):
    """The value one season before, whatever the horizon."""
    return _shifted(df, y, ts, list(keys), season, name)


def folds(
    df: DataFrame,
    ts: str,
    keys: list[str] = (),
    n_splits: int = 5,
    gap: int = DAY_PERIODS,
    on_short: str = "error",
) -> DataFrame:
    """Each row once per fold it belongs to, with (fold, role); training expands, tests move on.

    Fold i (from 0) tests the block that starts (n_splits - i) blocks before the end and trains
    on everything up to ``gap`` rows before it. Rows between are in neither role.
    """
    return fold_members(row_index(df, ts, list(keys)), n_splits, gap, on_short).drop("series_rows")


def fold_members(
    indexed: DataFrame, n_splits: int = 5, gap: int = DAY_PERIODS, on_short: str = "error", final: bool = False
) -> DataFrame:
    """``folds`` of rows that carry row_no and series_rows: narrow, so it can be redone per pass.

    ``final`` adds fold ``n_splits``, which trains on all rows. A series too short for the folds is an
    error; with ``on_short="skip"`` it has no folds but still takes part in the final one, and with "report" its rows
    appear once besides, without a fold and as role ``short``.
    """
    n, row = F.col("series_rows"), F.col("row_no")
    size = F.floor(n / (n_splits + 1))
    short = (size < 1) | ((n - gap - size * n_splits) <= 0)
    if on_short == "error":
        text = F.lit(f"a series is too short for {n_splits} folds with gap {gap}")
        rows = indexed.withColumn("row_no", F.when(short, F.raise_error(text).cast("long")).otherwise(row))
    else:
        rows = indexed if final or on_short == "report" else indexed.filter(~short)

    def member(i: int) -> Column:
        start = n - (n_splits - i) * size
        role = F.when(short, None).when((row >= start) & (row < start + size), "test").when(row < start - gap, "train")
        return F.when(role.isNotNull(), F.struct(F.lit(i).alias("fold"), role.alias("role")))

    members = [member(i) for i in range(n_splits)]
    if final:
        members.append(F.struct(F.lit(n_splits).alias("fold"), F.lit("train").alias("role")))
    if on_short == "report":
        members.append(F.when(short, F.struct(F.lit(None).cast("int").alias("fold"), F.lit("short").alias("role"))))
    return rows.withColumn("_member", F.explode(F.array_compact(F.array(*members)))).select(
        *indexed.columns, F.col("_member.fold").alias("fold"), F.col("_member.role").alias("role")
    )


def evaluation_table(df: DataFrame, actual: str, predictions: dict[str, tuple[str, float]]) -> DataFrame:
    """One row per model {name: (column, alpha)}: pinball, and MAE and RMSE for alpha 0.5."""
    entries = F.array(
        *[
            F.struct(F.lit(m).alias("model"), F.lit(a).alias("alpha"), F.col(c).cast("double").alias("predicted"))
            for m, (c, a) in predictions.items()
        ]
    )
    # A missing prediction gives a null error, which the averages skip; a model without any
    # prediction keeps its row, with null metrics.
    long = df.select(F.col(actual).cast("double").alias("actual"), F.inline(entries))
    error = F.col("predicted") - F.col("actual")
    central = F.col("alpha") == 0.5
    return long.groupBy("model", "alpha").agg(
        F.avg(pinball("actual", "predicted", F.col("alpha"))).alias("pinball"),
        F.avg(F.when(central, F.abs(error))).alias("mae"),
        F.sqrt(F.avg(F.when(central, error * error))).alias("rmse"),
    )


def decision_quality(df: DataFrame, actual: str, predicted: str, keys: list[str]) -> DataFrame:
    """Would a charge-below-median rule decide the same on the forecast as on the actual?

    (keys, mae_gco2, decision_error_pct, carbon_penalty_gco2, threshold_gco2): the penalty is the
    mean distance from the threshold of the wrongly decided rows, 0 when there are none.
    """
    rows = df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    thresholds = broadcast_if_small(exact_percentile(rows, actual, 0.5, keys, "threshold_gco2"))
    y, p, t = F.col(actual), F.col(predicted), F.col("threshold_gco2")
    wrong = (p < t) != (y < t)
    return (
        join_null_safe(rows, thresholds, keys)
        .groupBy(*keys)
        .agg(
            F.avg(F.abs(y - p)).alias("mae_gco2"),
            (F.avg(wrong.cast("int")) * 100).alias("decision_error_pct"),
            F.coalesce(F.avg(F.when(wrong, F.abs(y - t))), F.lit(0.0)).alias("carbon_penalty_gco2"),
            F.max("threshold_gco2").alias("threshold_gco2"),
        )
    )


def compare_variants(results: dict[str, DataFrame], alpha: float = 0.5, key: str = "region_id") -> DataFrame:
    """Loss at one alpha side by side: {variant: (key, alpha, pinball_loss)} -> a column each."""
    tagged = None
    for name, df in results.items():
        part = df.filter(F.col("alpha") == alpha).select(key, "pinball_loss").withColumn("model_type", F.lit(name))
        tagged = part if tagged is None else tagged.unionByName(part)
    return tagged.groupBy(key).agg(
        *[F.max(F.when(F.col("model_type") == n, F.col("pinball_loss"))).alias(n) for n in results]
    )


def calibration(df: DataFrame, actual: str, low: str, high: str, keys: list[str] = ()) -> DataFrame:
    """Percentage of actual values inside the predicted band."""
    inside = F.col(actual).between(F.col(low), F.col(high)).cast("int")
    return df.groupBy(*keys).agg((F.avg(inside) * 100).alias("inside_pct"))
