"""Models of spark.ml: importance by permutation, mixtures of sessions. Trees are grown in ``boosting``."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import GaussianMixture
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.operators.evaluate import pinball
from wattline.session import settled

MIXTURE_ROWS = 10_000  # vectors of a task while a mixture is fitted
MISSING = -1e12  # stands below every real value, so trees can split it off


def with_vector(df: DataFrame, features: list[str], name: str = "features") -> DataFrame:
    """Features as one vector; a missing value is kept as ``MISSING``, no row is dropped."""
    filled = [F.coalesce(F.col(f).cast("double"), F.lit(MISSING)) for f in features]
    return df.withColumn(name, array_to_vector(F.array(*filled)))


def _partner() -> Column:
    """A permutation of 0..n-1: multiply by a prime that does not divide n."""
    n, row = F.col("series_rows"), F.col("row_no")
    prime = F.when(n % 7919 != 0, F.lit(7919)).when(n % 7907 != 0, F.lit(7907)).otherwise(F.lit(1))
    return (row * prime + F.floor(n / 3)) % n


def permutation_importance(
    indexed: DataFrame, model, target: str, features: list[str], keys: list[str] = (), alpha: float = 0.5
) -> DataFrame:
    """(feature, importance): rise of the pinball loss when a feature is shuffled in its series.

    One self-join pairs each row with another of its series; the copies with one feature swapped
    are then scored and averaged in one pass.
    """
    keys = list(keys)
    filled = [F.coalesce(F.col(f).cast("double"), F.lit(MISSING)) for f in features]
    rows = indexed.select(*keys, "row_no", "series_rows", F.col(target).cast("double").alias("_y"), F.array(*filled).alias("own"))
    other = rows.select(*[F.col(k).alias(f"_o_{k}") for k in keys], F.col("row_no").alias("_o_row"), F.col("own").alias("other"))
    condition = F.col("_partner") == F.col("_o_row")
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_o_{k}"))
    paired = rows.withColumn("_partner", _partner()).join(other, condition)
    swaps = F.explode(F.sequence(F.lit(-1), F.lit(len(features) - 1)))
    swapped = F.expr("transform(own, (v, i) -> if(i = _swap, other[i], v))")
    scored = model.transform(
        paired.select("_y", "own", "other", swaps.alias("_swap")).withColumn("features", array_to_vector(swapped))
    )
    losses = scored.groupBy("_swap").agg(F.avg(pinball("_y", "prediction", alpha)).alias("_loss"))
    # One row per feature and one for none: small enough for one window.
    base = F.max(F.when(F.col("_swap") == -1, F.col("_loss"))).over(Window.partitionBy(F.lit(0)))
    names = F.array(*[F.lit(f) for f in features])
    return (
        losses.withColumn("importance", F.col("_loss") - base)
        .filter("_swap >= 0")
        .select(F.get(names, F.col("_swap")).alias("feature"), "importance")
        .orderBy(F.desc("importance"), "feature")
    )


def session_mixture(features: DataFrame, columns: list[str], k: int = 5, seed: int = 42, max_iter: int = 100):
    """(model, AIC, BIC) of a full-covariance Gaussian mixture over session features."""
    rows = features.dropna(subset=columns)
    # Stored once: every pass of the fit reads all vectors. Few rows are few tasks in each pass.
    vectors = settled(VectorAssembler(inputCols=columns, outputCol="features").transform(rows).select("features"))
    n, d = vectors.count(), len(columns)
    vectors = vectors.coalesce(max(1, -(-n // MIXTURE_ROWS)))
    model = GaussianMixture(k=k, seed=seed, maxIter=max_iter).fit(vectors)
    free = k - 1 + k * d + k * d * (d + 1) // 2
    log_likelihood = model.summary.logLikelihood
    return model, 2 * free - 2 * log_likelihood, free * math.log(n) - 2 * log_likelihood


def mixture_likelihood(features: DataFrame, columns: list[str], model) -> DataFrame:
    """(n, log_likelihood) of rows under a fitted mixture, from its weights, means and covariances."""
    parts = []
    for weight, row in zip(model.weights, model.gaussiansDF.collect(), strict=True):  # a row for each component
        covariance = np.array(row["cov"].toArray())
        _, size = np.linalg.slogdet(covariance)
        parts.append((np.log(weight) - (size + len(columns) * math.log(2 * math.pi)) / 2, row["mean"].toArray(), np.linalg.inv(covariance)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns])
            each = np.column_stack([a - np.einsum("ij,jk,ik->i", x - m, inverse, x - m) / 2 for a, m, inverse in parts])
            top = each.max(axis=1)
            total = float((top + np.log(np.exp(each - top[:, None]).sum(axis=1))).sum())
            yield pa.record_batch([pa.array([len(x)], pa.int64()), pa.array([total])], names=["n", "log_likelihood"])

    rows = features.dropna(subset=columns).select(*[F.col(c).cast("double").alias(c) for c in columns])
    return rows.mapInArrow(run, "n long, log_likelihood double").agg(F.sum("n").alias("n"), F.sum("log_likelihood").alias("log_likelihood"))
