"""Stored models by variant and day, and the log of training runs.

A day's models are a Parquet folder of their own name below ``variant=…/model_date=…``; a manifest that names the
folder and counts its rows is written last. Readers go by complete manifests only, so a day that is being
written, or was broken off, is passed over, and a second run on a day takes the first one's place at once.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.sources.tables import append_run_log, child_names

MANIFEST = "variant string, model_date date, folder string, n_models long, keys array<string>"


def _day_path(base: str, variant: str, day: str) -> str:
    return f"{base}/variant={variant}/model_date={day}"


def save_models(
    models: DataFrame, base: str, variant: str, model_date: dt.date | None = None, keys: list[str] = ()
) -> str:
    """Stores one row per model; ``keys`` are the columns that name a series. The folder of the day is returned."""
    spark = models.sparkSession
    day = model_date or dt.datetime.now(dt.timezone.utc).date()
    path = _day_path(base, variant, day.isoformat())
    folder = f"models-{uuid.uuid4().hex}"
    models.write.parquet(f"{path}/{folder}")
    n = spark.read.parquet(f"{path}/{folder}").count()
    number = sum(name.startswith("manifest-") for name in child_names(spark, path))
    row = [(variant, day, folder, n, list(keys))]
    spark.createDataFrame(row, MANIFEST).coalesce(1).write.parquet(f"{path}/manifest-{number:06d}-{uuid.uuid4().hex[:6]}")
    return path


def manifests(spark: SparkSession, base: str, variant: str) -> list:
    """Complete manifests of a variant, newest day and newest run of a day first."""
    found = []
    days = [n for n in child_names(spark, f"{base}/variant={variant}") if n.startswith("model_date=")]
    for day in sorted(days, reverse=True):
        path = f"{base}/variant={variant}/{day}"
        for name in sorted((n for n in child_names(spark, path) if n.startswith("manifest-")), reverse=True):
            if "_SUCCESS" in child_names(spark, f"{path}/{name}"):
                found.append(spark.read.schema(MANIFEST).parquet(f"{path}/{name}").first())
    return found


def load_latest_models(spark: SparkSession, base: str, variant: str, names: list[str] = ()) -> DataFrame:
    """The newest complete day's models, with ``variant`` and ``model_date``; a day without one of ``names`` (of column
    name) or with fewer rows than its manifest says is an error, as those who wrote it meant it to be whole."""
    known = manifests(spark, base, variant)
    if not known:
        raise FileNotFoundError(f"no models of variant {variant} below {base}")
    last = known[0]
    models = spark.read.parquet(f"{_day_path(base, variant, last['model_date'].isoformat())}/{last['folder']}")
    n = models.count()
    if n != last["n_models"]:
        raise ValueError(f"{n} models of variant {variant}, {last['model_date']}; its manifest has {last['n_models']}")
    if names:
        held = {r[0] for r in models.filter(F.col("name").isin(*names)).select("name").distinct().collect()}
        lacking = [x for x in names if x not in held]
        if lacking:
            raise ValueError(f"models of variant {variant}, {last['model_date']}, lack {', '.join(lacking)}")
    return models.withColumn("variant", F.lit(variant)).withColumn("model_date", F.lit(last["model_date"]))


def without_model(df: DataFrame, models: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n_rows) of the series that no model covers, which scoring leaves out."""
    same = None
    held = models.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    for k in keys:
        one = F.col(k).eqNullSafe(F.col(f"_{k}"))
        same = one if same is None else same & one
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).join(held, same, "left_anti")


def log_training(
    spark: SparkSession, path: str | None, name: str, params: dict, losses: dict[float, float], rows: int
) -> None:
    """A row for each quantile's run: its parameters, the rows trained on and the out-of-fold loss. No path, no log."""
    for alpha, loss in losses.items() if path else ():
        run = {"run": f"{name}_alpha_{alpha}", "objective": "quantile", "alpha": alpha, **params, "training_rows": rows}
        append_run_log(spark, path, run, {"oof_pinball_loss": loss})


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """(run_at, run, params, metrics), oldest first."""
    return spark.read.parquet(path).select("run_at", F.col("params")["run"].alias("run"), "params", "metrics").orderBy("run_at")
