"""Summaries: profiles, exact percentiles, pivots, extents, top rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.functions.columns import join_null_safe

PERCENTILE_BINS = 64


def profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, standard deviation, min and max of each column, in one pass."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    names = columns or numeric
    one_row = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(c).alias("n"),
                F.avg(c).cast("double").alias("mean"),
                F.stddev(c).cast("double").alias("stddev"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(f"_p{i}")
            for i, c in enumerate(names)
        ]
    )
    return one_row.select(F.inline(F.array(*[f"_p{i}" for i in range(len(names))])))


def group_mean(df: DataFrame, keys: list[str], columns: list[str], prefix: str = "mean_") -> DataFrame:
    return df.groupBy(*keys).agg(*[F.avg(c).alias(f"{prefix}{c}") for c in columns])


def group_counts(df: DataFrame, keys: list[str], distinct: str | None = None) -> DataFrame:
    counts = [F.count(F.lit(1)).alias("n_rows")]
    if distinct:
        counts.append(F.countDistinct(distinct).alias(f"n_{distinct}"))
    return df.groupBy(*keys).agg(*counts) if keys else df.agg(*counts)


def pivot_values(df: DataFrame, key: str, column: str, values: dict, measure: str) -> DataFrame:
    """One row per ``key`` and a column per entry of ``values`` {name: value of ``column``}."""
    return df.groupBy(key).agg(
        *[
            F.first(F.when(F.col(column) == v, F.col(measure)), ignorenulls=True).alias(name)
            for name, v in values.items()
        ]
    )


def time_extent(df: DataFrame, ts: str, keys: list[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.min(ts).alias("earliest"), F.max(ts).alias("latest"), F.count(F.lit(1)).alias("n_rows")
    )


def top_rows(df: DataFrame, order: list, n: int) -> DataFrame:
    """First ``n`` rows in an order; Spark keeps only ``n`` rows per task on the way."""
    return df.orderBy(*order).limit(n)


def exact_percentile(
    df: DataFrame, column: str, q: float, keys: list[str] = (), name: str = "percentile", most_values: int = 200_000
) -> DataFrame:
    """Exact interpolated percentile per group, without ordering a large group in one task.

    Equal values are counted first, which shrinks a group to its distinct values. While a group
    has more than ``most_values`` of those, they are split into bins at approximate percentiles
    and only the one or two bins that hold the wanted ranks go on.
    """
    if not keys:
        one_group = df.select(F.lit(0).alias("_all"), column)
        return exact_percentile(one_group, column, q, ["_all"], name, most_values).drop("_all")
    keys = list(keys)
    counted = (
        df.filter(F.col(column).isNotNull())
        .groupBy(*keys, F.col(column).alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    most = counted.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    # ``_below`` is how many rows lie under the values kept, ``_rank`` the position looked for.
    if most <= most_values:
        total = F.sum("_n").over(Window.partitionBy(*keys))
        kept = counted.withColumns({"_below": F.lit(0).cast("long"), "_rank": F.lit(q) * (total - 1)})
    else:
        ranks = counted.groupBy(*keys).agg((F.lit(q) * (F.sum("_n") - 1)).alias("_rank"))
        kept = join_null_safe(counted.withColumn("_below", F.lit(0).cast("long")), ranks, keys)
        while most > most_values:
            kept = _keep_wanted_bins(kept, keys)
            most //= PERCENTILE_BINS // 2
    inside = Window.partitionBy(*keys, "_below").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    placed = kept.withColumn("_to", F.col("_below") + F.sum("_n").over(inside))

    def holds(position: Column) -> Column:
        return F.max(F.when((position < F.col("_to")) & (position >= F.col("_to") - F.col("_n")), F.col("_v")))

    found = placed.groupBy(*keys).agg(
        holds(F.floor("_rank")).cast("double").alias("_low"),
        holds(F.ceil("_rank")).cast("double").alias("_high"),
        F.max(F.col("_rank") - F.floor("_rank")).alias("_part"),
    )
    return found.select(*keys, (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_part")).alias(name))


def _keep_wanted_bins(values: DataFrame, keys: list[str]) -> DataFrame:
    """Values (_v, _n) of the bins that hold rank ``_rank``, with ``_below`` moved up to each bin."""
    marks = [i / PERCENTILE_BINS for i in range(1, PERCENTILE_BINS)]
    group = [*keys, "_below"]
    edges = values.groupBy(*group).agg(F.percentile_approx("_v", marks, 1000).alias("_edges"))
    binned = join_null_safe(values, edges, group).withColumn("_bin", F.expr("size(filter(_edges, e -> e < _v))"))
    in_order = Window.partitionBy(*group).orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    bins = (
        binned.groupBy(*group, "_bin")
        .agg(F.sum("_n").alias("_bin_n"), F.max("_rank").alias("_at"))
        .withColumn("_end", F.col("_below") + F.sum("_bin_n").over(in_order))
        .withColumn("_start", F.col("_end") - F.col("_bin_n"))
        .filter((F.col("_start") <= F.ceil("_at")) & (F.col("_end") > F.floor("_at")))
        .select(*group, "_bin", "_start")
    )
    wanted = join_null_safe(binned, bins, [*group, "_bin"])
    return wanted.select(*keys, "_v", "_n", F.col("_start").alias("_below"), "_rank")
