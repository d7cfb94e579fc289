"""Training runs from rows to stored models: fit, out-of-fold loss, run log, store, and scoring from the store."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.functions.reference import ALPHAS, DAY_PERIODS
from wattline.operators import boosting, quantiles
from wattline.operators.attribution import score as score_trees
from wattline.session import settled
from wattline.sources.models import load_latest_models, log_training, save_models, without_model


def train_trees(
    indexed: DataFrame,
    target: str,
    features: list[str],
    base: str,
    variant: str,
    model_date: dt.date | None = None,
    log: str | None = None,
    alphas: list[float] = ALPHAS,
    n_splits: int = 5,
    gap: int = DAY_PERIODS,
    **growth,
) -> tuple[DataFrame, DataFrame]:
    """Boosted quantile trees of one table of rows: (out-of-fold predictions, losses). The models trained on all rows are
    stored, their features in ``features``."""
    models, predicted = boosting.train_quantiles(indexed, target, features, alphas, n_splits, gap, **growth)
    predicted = settled(predicted)
    losses = settled(quantiles.loss_summary(predicted, target, alphas=alphas))
    shape = boosting.Model("", 0, **growth)
    params = {"n_estimators": shape.rounds, "learning_rate": shape.rate, "max_depth": shape.depth, "n_splits": n_splits, "gap": gap}
    found = {r["alpha"]: r["pinball_loss"] for r in losses.collect()}
    log_training(indexed.sparkSession, log, f"{variant}_trees", params, found, indexed.count())
    names = F.array(*[F.lit(f) for f in features])
    save_models(models.filter(F.col("fold") == n_splits).withColumn("features", names), base, variant, model_date)
    return predicted, losses


def train_series(
    df: DataFrame,
    target: str,
    features: list[str],
    ts: str,
    keys: list[str],
    base: str,
    variant: str,
    model_date: dt.date | None = None,
    log: str | None = None,
    alphas: list[float] = ALPHAS,
    n_splits: int = 5,
    gap: int = DAY_PERIODS,
) -> DataFrame:
    """Linear quantile models of every series: losses by series and quantile. All folds' models are stored."""
    df = settled(df)
    models, summary = quantiles.train_per_series(df, target, features, ts, keys, alphas, n_splits, gap)
    means = {r["alpha"]: r["loss"] for r in summary.groupBy("alpha").agg(F.avg("pinball_loss").alias("loss")).collect()}
    if log:
        log_training(df.sparkSession, log, f"{variant}_series", {"n_splits": n_splits, "gap": gap}, means, df.count())
    names = F.array(*[F.lit(f) for f in features])
    save_models(models.withColumn("features", names), base, variant, model_date, keys)
    return summary


def _features(models: DataFrame) -> list[str]:
    """The features models were trained on, in order; models of one day share them."""
    return models.select("features").first()[0]


def score_stored_trees(df: DataFrame, base: str, variant: str, names: list[str] = ("p10", "p50", "p90")) -> DataFrame:
    models = load_latest_models(df.sparkSession, base, variant, list(names))
    return score_trees(df, models, _features(models), list(names))


def score_stored_series(
    df: DataFrame, base: str, variant: str, keys: list[str], alphas: list[float] = ALPHAS
) -> tuple[DataFrame, DataFrame]:
    """(scored rows, series that have rows but no model) with the newest complete day's models."""
    models = load_latest_models(df.sparkSession, base, variant)
    scored = quantiles.score(df, models, _features(models), keys, alphas)
    return scored, without_model(df, models, keys)
