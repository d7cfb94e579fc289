"""Linear quantile regression of many series at once, as repeated grouped aggregations.

Every series, fold and quantile is one small model. Each pass replaces the quantile loss by the
quadratic that touches it at the present residuals and lies above it elsewhere (majorisation, a
published method), which needs no scale of the errors, and goes to its minimum and somewhat beyond.
A pass sums the normal equations per model; the sums are combined map-side, so a hot series costs
its task no more than any other. The step itself (a few dozen numbers per model) is solved as rows
of a distributed table. Models whose loss no longer falls leave the passes; one that still moves
after the last pass is marked as not converged.

Series of up to ``IN_TASK`` rows take the same steps inside one task each, without a job per pass.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.functions.columns import join_null_safe
from wattline.functions.reference import ALPHAS, DAY_PERIODS
from wattline.operators.evaluate import fold_members, pinball
from wattline.operators.windows import row_index
from wattline.session import BROADCAST_BYTES, settled, ship

RIDGE = 1e-8
PASSES = 60  # at most
SETTLED = 2e-4  # relative fall of the loss in one pass at which a model is done
SHARPNESS = 0.01  # residuals count as this share of their mean size at least
IN_TASK = 200_000  # rows of a series that one task may hold: 16 MB with nine features
BEYOND = 1.7  # length of a step in distances to the quadratic's minimum; below 2 the loss still falls


def quantile_name(alpha: float) -> str:
    return f"p{round(alpha * 100)}"


def _dot(features: list[str], coef: str) -> Column:
    terms = " + ".join(f"{coef}[{i + 1}] * `{f}`" for i, f in enumerate(features))
    return F.expr(f"{coef}[0] + {terms}")


def _pairs(features: list[str]) -> tuple[list[str], list[str]]:
    x = ["1.0D", *[f"`{f}`" for f in features]]
    return x, [f"{x[i]} * {x[j]}" for i in range(len(x)) for j in range(i, len(x))]


def _start_sums(rows: DataFrame, by: list[str], features: list[str], target: str) -> DataFrame:
    """Least-squares sums per model: x·xT (upper triangle), x·y, y·y."""
    x, pairs = _pairs(features)
    return rows.groupBy(*by).agg(
        F.expr(f"array({', '.join(f'sum({p})' for p in pairs)})").alias("gram"),
        F.expr(f"array({', '.join(f'sum({xi} * `{target}`)' for xi in x)})").alias("cross"),
        F.sum(F.col(target) * F.col(target)).alias("square"),
    )


def _step_sums(rows: DataFrame, by: list[str], features: list[str], target: str) -> DataFrame:
    """Normal equations of the touching quadratic per model, and its loss; ``_r`` is the residual."""
    x, pairs = _pairs(features)
    size = F.abs("_r") + F.col("scale") * SHARPNESS
    weighed = rows.withColumns({"_w": 1 / size, "_t": F.col(target) / size + 2 * F.col("alpha") - 1})
    return weighed.groupBy(*by).agg(
        F.expr(f"array({', '.join(f'sum(_w * {p})' for p in pairs)})").alias("gram"),
        F.expr(f"array({', '.join(f'sum(_t * {xi})' for xi in x)})").alias("cross"),
        F.avg(F.greatest(F.col("alpha") * F.col("_r"), (F.col("alpha") - 1) * F.col("_r"))).alias("loss"),
        F.avg(F.abs("_r")).alias("size"),
        F.first("coef").alias("coef"),
        F.first("before").alias("before"),
    )


def _solve(sums: DataFrame, by: list[str], size: int) -> DataFrame:
    """(by, coef, scale, before, converged): the least-squares fit, or the coefficients one step further.

    A model whose loss has not fallen keeps its coefficients and has converged."""
    ridge, stepping, beyond, settled_at = RIDGE, "coef" in sums.columns, BEYOND, SETTLED

    def solve(batches):
        import numpy as np

        upper = np.triu_indices(size)

        def solved(gram, cross):
            a = np.zeros((size, size))
            a[upper] = gram
            a = a + a.T - np.diag(a.diagonal())
            unit = np.sqrt(np.maximum(a.diagonal(), 1e-12))
            scaled = a / np.outer(unit, unit) + ridge * np.eye(size)
            return np.linalg.solve(scaled, np.asarray(cross) / unit) / unit

        for pdf in batches:
            found = [solved(g, c) for g, c in zip(pdf["gram"], pdf["cross"])]
            if stepping:
                old = [np.asarray(c) for c in pdf["coef"]]
                pdf["converged"] = (pdf["before"] - pdf["loss"] <= settled_at * pdf["before"]).fillna(False)
                found = [o if done else o + beyond * (f - o) for o, f, done in zip(old, found, pdf["converged"])]
                pdf["scale"], pdf["before"] = pdf["size"] + 1e-9, pdf["loss"]
            else:
                pdf["before"], pdf["converged"] = None, False
                # Sum of squared residuals of a least-squares fit is y·y - coef·(x·y).
                left = [max(q - float(b @ np.asarray(c)), 0.0) for q, b, c in zip(pdf["square"], found, pdf["cross"])]
                pdf["scale"] = [float(np.sqrt(s / max(g[0], 1.0))) + 1e-6 for s, g in zip(left, pdf["gram"])]
            pdf["coef"] = found
            pdf["before"] = pdf["before"].astype("float64")
            yield pdf[[*by, "coef", "scale", "before", "converged"]]

    kept = sums.select(*by).schema.add("coef", T.ArrayType(T.DoubleType())).add("scale", "double")
    return sums.mapInPandas(solve, kept.add("before", "double").add("converged", "boolean"))


def _normal(gram: np.ndarray, cross: np.ndarray) -> np.ndarray:
    """Solution of normal equations, with a little ridge on scaled columns."""
    unit = np.sqrt(np.maximum(gram.diagonal(), 1e-12))
    return np.linalg.solve(gram / np.outer(unit, unit) + RIDGE * np.eye(len(unit)), cross / unit) / unit


def fit_rows(x: np.ndarray, y: np.ndarray, alpha: float, passes: int = PASSES) -> tuple[np.ndarray, bool]:
    """(coefficients, converged) on rows of one task; the steps are those of ``fit``."""
    coef = _normal(x.T @ x, x.T @ y)
    scale, before = float(np.sqrt(np.maximum(y @ y - coef @ (x.T @ y), 0.0) / max(len(y), 1))) + 1e-6, None
    for _ in range(passes):
        r = y - x @ coef
        size, loss = np.abs(r) + scale * SHARPNESS, float(np.maximum(alpha * r, (alpha - 1) * r).mean())
        if before is not None and before - loss <= SETTLED * before:
            return coef, True
        found = _normal((x / size[:, None]).T @ x, x.T @ (y / size + 2 * alpha - 1))
        coef, scale, before = coef + BEYOND * (found - coef), float(np.abs(r).mean()) + 1e-9, loss
    return coef, False


def _fit_in_tasks(
    indexed: DataFrame, target: str, features: list[str], keys: list[str], alphas: list[float], n_splits: int, gap: int, passes: int
) -> DataFrame:
    """As ``fit``, for series that one task may hold."""
    ship(indexed.sparkSession)
    named = {f"_k{i}": k for i, k in enumerate(keys)}
    by = list(named) or ["_k"]
    columns = [F.col(k).alias(n) for n, k in named.items()] or [F.lit(0).alias("_k")]
    rows = indexed.select(*columns, F.col("row_no").alias("_row"), F.col(target).alias("_y"), *[F.col(f).alias(f"_x{i}") for i, f in enumerate(features)])
    out = T.StructType([rows.schema[n] for n in by])
    out = out.add("fold", T.IntegerType()).add("alpha", T.DoubleType()).add("coef", T.ArrayType(T.DoubleType())).add("converged", T.BooleanType())

    def run(series: pa.Table) -> pa.Table:
        row, y = (series.column(c).to_numpy() for c in ("_row", "_y"))
        x = np.column_stack([np.ones(len(y)), *[series.column(f"_x{i}").to_numpy() for i in range(len(features))]])
        n, size = len(y), len(y) // (n_splits + 1)
        short = size < 1 or n - gap - size * n_splits <= 0
        ends = {} if short else {i: n - (n_splits - i) * size - gap for i in range(n_splits)}
        found = []
        for fold, end in {**ends, n_splits: n}.items():
            train = row < end
            found += [(fold, float(a), *fit_rows(x[train], y[train], a, passes)) for a in alphas]
        fold, alpha, coef, converged = zip(*found, strict=True)
        keys_of = [series.column(c).combine_chunks().take(pa.array([0] * len(found))) for c in by]
        return pa.Table.from_arrays(
            [*keys_of, pa.array(fold, pa.int32()), pa.array(alpha), pa.array([c.tolist() for c in coef], pa.list_(pa.float64())), pa.array(converged)],
            names=[*by, "fold", "alpha", "coef", "converged"],
        )

    fitted = rows.groupBy(*by).applyInArrow(run, out)
    return fitted.select(*[F.col(n).alias(k) for n, k in named.items()], "fold", "alpha", "coef", "converged")


def indexed_rows(df: DataFrame, target: str, features: list[str], ts: str, keys: list[str]) -> DataFrame:
    """Complete rows as doubles, with their position in the series."""
    rows = df.select(
        *keys, ts, F.col(target).cast("double").alias(target), *[F.col(f).cast("double").alias(f) for f in features]
    ).dropna(subset=[ts, target, *features])
    return row_index(rows, ts, keys)


def fit(
    indexed: DataFrame,
    target: str,
    features: list[str],
    keys: list[str] = (),
    alphas: list[float] = ALPHAS,
    n_splits: int = 5,
    gap: int = DAY_PERIODS,
    passes: int = PASSES,
    in_task: int = IN_TASK,
) -> DataFrame:
    """(keys, fold, alpha, coef, converged) for every walk-forward fold, and fold ``n_splits`` for all rows.

    A series too short for the folds has the last model only. Series of more than ``in_task`` rows are fitted in
    passes over all rows; coefficients are checkpointed after each pass, so the plan does not grow with them.
    """
    keys = list(keys)
    few, many = indexed.agg(F.count_if(F.col("series_rows") <= in_task), F.count_if(F.col("series_rows") > in_task)).first()
    small = indexed.filter(F.col("series_rows") <= in_task)
    found = settled(_fit_in_tasks(small, target, features, keys, alphas, n_splits, gap, passes)) if few else None
    if not many and found is not None:
        return found
    large = _fit_in_passes(indexed.filter(F.col("series_rows") > in_task), target, features, keys, alphas, n_splits, gap, passes)
    return large if found is None else settled(found.unionByName(large))


def _fit_in_passes(
    indexed: DataFrame, target: str, features: list[str], keys: list[str], alphas: list[float], n_splits: int, gap: int, passes: int
) -> DataFrame:
    train = fold_members(indexed, n_splits, gap, "skip", final=True).filter("role = 'train'")
    size = len(features) + 1
    start = _solve(_start_sums(train, [*keys, "fold"], features, target), [*keys, "fold"], size)
    each_alpha = F.explode(F.array(*[F.lit(float(a)) for a in alphas]))
    by = [*keys, "fold", "alpha"]
    columns = [*by, "coef", "scale", "before", "converged"]
    models = settled(start.withColumn("alpha", each_alpha).select(*columns))
    few = models.count() * 8 * (size + 8) <= BROADCAST_BYTES  # the number of models stays the same
    done: list[DataFrame] = []
    for _ in range(passes):
        current = join_null_safe(train, F.broadcast(models) if few else models, [*keys, "fold"]).withColumn("_r", F.col(target) - _dot(features, "coef"))
        models = settled(_solve(_step_sums(current, by, features, target), by, size).select(*columns))
        done.append(models.filter("converged"))
        models = models.filter("not converged")
        if models.isEmpty():
            break
    return settled(reduce(DataFrame.unionByName, done, models)).drop("scale", "before")


def _wide_models(models: DataFrame, by: list[str], alphas: list[float]) -> DataFrame:
    return models.groupBy(*by).agg(
        *[
            F.first(F.when(F.col("alpha") == a, F.col("coef")), ignorenulls=True).alias(f"_coef_{quantile_name(a)}")
            for a in alphas
        ]
    )


def _predict(rows: DataFrame, models: DataFrame, by: list[str], features: list[str], alphas: list[float]) -> DataFrame:
    # One row per series and fold: read once, and broadcast while its bytes are few, so rows stay where they are.
    wide = settled(_wide_models(models, by, alphas))
    numbers = wide.agg(F.sum(reduce(lambda a, b: a + b, [F.size(f"_coef_{quantile_name(a)}") for a in alphas]))).first()[0]
    small = (numbers or 0) * 8 <= BROADCAST_BYTES
    joined = join_null_safe(rows, F.broadcast(wide) if small else wide, by)
    names = [quantile_name(a) for a in alphas]
    return joined.withColumns({n: _dot(features, f"_coef_{n}") for n in names}).drop(*[f"_coef_{n}" for n in names])


def out_of_fold(
    indexed: DataFrame,
    models: DataFrame,
    features: list[str],
    keys: list[str] = (),
    alphas: list[float] = ALPHAS,
    n_splits: int = 5,
    gap: int = DAY_PERIODS,
) -> DataFrame:
    """Each row of a test block once, predicted by the model of its fold."""
    test = fold_members(indexed, n_splits, gap, "skip").filter("role = 'test'")
    return _predict(test, models, [*list(keys), "fold"], features, alphas)


def score(df: DataFrame, models: DataFrame, features: list[str], keys: list[str] = (), alphas: list[float] = ALPHAS):
    """``df`` with a column per quantile from the final models; series without a model are left out."""
    final = models.filter(F.col("fold") == models.agg(F.max("fold")).first()[0]) if "fold" in models.columns else models
    if keys:
        return _predict(df, final, list(keys), features, alphas)
    one = final.withColumn("_all", F.lit(0))
    return _predict(df.withColumn("_all", F.lit(0)), one, ["_all"], features, alphas).drop("_all")


def loss_summary(predicted: DataFrame, target: str, keys: list[str] = (), alphas: list[float] = ALPHAS) -> DataFrame:
    """(keys, alpha, mae, pinball_loss): one row per model, from out-of-fold predictions."""
    wide = predicted.groupBy(*keys).agg(
        *[
            F.struct(
                F.lit(float(a)).alias("alpha"),
                F.avg(F.abs(F.col(target) - F.col(quantile_name(a)))).alias("mae"),
                F.avg(pinball(target, quantile_name(a), float(a))).alias("pinball_loss"),
            ).alias(f"_m{i}")
            for i, a in enumerate(alphas)
        ]
    )
    return wide.select(*keys, F.inline(F.array(*[f"_m{i}" for i in range(len(alphas))])))


def train_per_series(
    df: DataFrame,
    target: str,
    features: list[str],
    ts: str,
    keys: list[str],
    alphas: list[float] = ALPHAS,
    n_splits: int = 5,
    gap: int = DAY_PERIODS,
    passes: int = PASSES,
) -> tuple[DataFrame, DataFrame]:
    """(models, summary) of every series at once.

    The indexed rows stay cached on disk while passes repeat; a lost executor recomputes its part.
    """
    indexed = indexed_rows(df, target, features, ts, keys).persist(StorageLevel.MEMORY_AND_DISK)
    models = fit(indexed, target, features, keys, alphas, n_splits, gap, passes)
    predicted = out_of_fold(indexed, models, features, keys, alphas, n_splits, gap)
    summary = settled(loss_summary(predicted, target, keys, alphas))
    indexed.unpersist()
    return models, summary
