"""Write rules: first wins, insert only, last wins; dated snapshots; versioned tables.

Three rules are kept apart on purpose. None needs a transactional table format: each is an
anti-join or an aggregation on the keys, followed by an append or by a new version.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# ---- DataFrame forms ---------------------------------------------------------------------


def first_per_key(df: DataFrame, keys: list[str], order: list[Column], last: bool = False) -> DataFrame:
    """One row per key: the first (or last) in ``order``.

    An aggregation, not a ranking window: copies of a hot key are reduced before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]).alias("o"), *[F.col(c) for c in rest])
    # Order columns come first; remaining columns only break ties, so the choice is repeatable.
    picked = (F.max if last else F.min)(row)
    return df.groupBy(*keys).agg(picked.alias("_row")).select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns]
    )


def new_rows(target: DataFrame, batch: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Rows of ``batch`` whose key ``target`` lacks; of duplicates in the batch the first."""
    return join_null_safe_anti(first_per_key(batch, keys, order), target, keys)


def join_null_safe_anti(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    present = right.select(*[F.col(k).alias(f"_right_{k}") for k in keys])
    condition = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"_right_{k}"))
        condition = same if condition is None else condition & same
    return left.join(present, condition, "left_anti")


def insert_or_ignore(target: DataFrame, batch: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Target after the batch: what was there stays, the first row of each new key is added."""
    return target.unionByName(new_rows(target, batch, keys, order))


def merge_insert_only(target: DataFrame | None, staging: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """As ``insert_or_ignore``; without a target the staging rows make it."""
    if target is None:
        return first_per_key(staging, keys, order)
    return insert_or_ignore(target, staging, keys, order)


def append_keep_last(target: DataFrame | None, batch: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """Union in which the later row of a key replaces the earlier; without a key, a plain append."""
    both = batch.withColumn("_batch", F.lit(1))
    if target is not None:
        both = target.withColumn("_batch", F.lit(0)).unionByName(both, allowMissingColumns=True)
    if not key or any(k not in both.columns for k in key):
        return both.drop("_batch")
    return first_per_key(both, key, [F.col("_batch"), *order], last=True).drop("_batch")


# ---- paths -------------------------------------------------------------------------------


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path`` on whatever file system it is; none if it is absent."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(where))


def merge_into_path(
    spark: SparkSession, path: str, staging: DataFrame, keys: list[str], order: list[Column], time_key: str | None = None
) -> None:
    """Append to a Parquet path the staging rows whose key it lacks; creates the path.

    With ``time_key`` only the part of the target in the staging's time range is read.
    """
    if not child_names(spark, path):
        first_per_key(staging, keys, order).write.mode("append").parquet(path)
        return
    target = spark.read.parquet(path)
    if time_key:
        lo, hi = staging.agg(F.min(time_key), F.max(time_key)).first()
        if lo is not None:
            inside = F.col(time_key).between(F.lit(lo), F.lit(hi)) | F.col(time_key).isNull()
            target = target.filter(inside)
    new_rows(target, staging, keys, order).write.mode("append").parquet(path)


def overwrite_layer(df: DataFrame, path: str, partition_by: list[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def truncate_layer(spark: SparkSession, path: str) -> None:
    """Empty a layer and keep its schema."""
    schema = spark.read.parquet(path).schema
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def read_version(spark: SparkSession, path: str) -> DataFrame | None:
    """Newest complete version of a versioned table, or None."""
    done = [v for v in child_names(spark, path) if v.startswith("version=") and "_SUCCESS" in child_names(spark, f"{path}/{v}")]
    return spark.read.parquet(f"{path}/{done[-1]}") if done else None


def write_version(spark: SparkSession, path: str, df: DataFrame) -> str:
    """Write ``df`` as the next version; readers switch when it is complete, so ``df`` may read the old one."""
    taken = [int(v.split("=")[1].split("-")[0]) for v in child_names(spark, path) if v.startswith("version=")]
    name = f"{path}/version={max(taken, default=0) + 1:06d}-{uuid.uuid4().hex[:6]}"
    df.write.parquet(name)
    return name


def append_keep_last_path(spark: SparkSession, path: str, batch: DataFrame, key: list[str], order: list[Column]) -> str:
    return write_version(spark, path, append_keep_last(read_version(spark, path), batch, key, order))


def append_keep_last_days(
    spark: SparkSession, path: str, batch: DataFrame, key: list[str], order: list[Column], time: str
) -> list[str]:
    """As ``append_keep_last`` on a table kept by day of ``time``: only the batch's days are read and written.

    A day's rows are one complete version below ``day=…``; a new one takes the old one's place by a rename, so a
    reader, or a run that is broken off, sees the day as it was or as it is to be. ``time`` is part of the key: a row
    can only replace one of its own day. Days are in the session's time zone; rows without a time are a day of their
    own. The days written are returned."""
    if time not in key:
        raise ValueError(f"rows of one key may lie on several days: {time} is not part of {key}")
    dated = batch.withColumn("_day", F.coalesce(F.date_format(time, "yyyy-MM-dd"), F.lit(NO_DAY)))
    days = sorted(r[0] for r in dated.select("_day").distinct().collect())  # one row for each day of the batch
    if not days:
        return []
    before = read_days(spark, path, days)
    merged = append_keep_last(before, batch, key, order)
    merged = merged.withColumn("_day", F.coalesce(F.date_format(time, "yyyy-MM-dd"), F.lit(NO_DAY)))
    staging = f"{path}/_staging-{uuid.uuid4().hex}"
    # Few files for small days; adaptive execution splits large ones.
    merged.hint("rebalance", "_day").write.partitionBy("_day").parquet(staging)
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    where = jvm.org.apache.hadoop.fs.Path
    for day in days:
        old = _day_versions(spark, path, day)
        number = int(old[-1].split("=")[1].split("-")[0]) + 1 if old else 1
        fs.mkdirs(where(f"{path}/day={day}"))
        # Names sort by number; a run that is broken off here leaves whole days only.
        fs.rename(where(f"{staging}/_day={day}"), where(f"{path}/day={day}/version={number:06d}-{uuid.uuid4().hex[:6]}"))
        for name in old[:-1]:  # a reader may still hold the last one
            fs.delete(where(f"{path}/day={day}/{name}"), True)
    fs.delete(where(staging), True)
    return days


NO_DAY = "none"


def _day_versions(spark: SparkSession, path: str, day: str) -> list[str]:
    return [v for v in child_names(spark, f"{path}/day={day}") if v.startswith("version=")]


def read_days(spark: SparkSession, path: str, days: list[str] | None = None) -> DataFrame | None:
    """The newest version of each day, or of ``days`` only; None if there is none."""
    known = [n.split("=", 1)[1] for n in child_names(spark, path) if n.startswith("day=")]
    folders = []
    for day in known if days is None else [d for d in known if d in set(days)]:
        versions = _day_versions(spark, path, day)
        folders += [f"{path}/day={day}/{versions[-1]}"] if versions else []
    return spark.read.option("mergeSchema", "true").parquet(*folders) if folders else None


def write_snapshot(df: DataFrame, base: str, run_date: dt.date | None = None) -> str:
    """Features of one run date; a second run on the date replaces the first."""
    day = run_date or dt.datetime.now(dt.timezone.utc).date()
    path = f"{base}/run_date={day.isoformat()}"
    df.write.mode("overwrite").parquet(path)
    return path


def load_latest_snapshot(spark: SparkSession, base: str) -> DataFrame:
    """The newest complete snapshot; one that is being written, or was broken off, doesn't count."""
    for day in sorted((n for n in child_names(spark, base) if n.startswith("run_date=")), reverse=True):
        if "_SUCCESS" in child_names(spark, f"{base}/{day}"):
            return spark.read.parquet(f"{base}/{day}")
    raise FileNotFoundError(f"no snapshot below {base}")


def append_run_log(spark: SparkSession, path: str, params: dict, metrics: dict[str, float]) -> None:
    """One row per training run: time, parameters as JSON, metric values."""
    row = [(dt.datetime.now(dt.timezone.utc), {k: str(v) for k, v in params.items()}, dict(metrics))]
    schema = "run_at timestamp, params map<string,string>, metrics map<string,double>"
    spark.createDataFrame(row, schema).write.mode("append").parquet(path)
