"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "wattline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on; ``conf`` adds or overrides."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # Call-site capture costs milliseconds per column expression while a plan is built.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings that change results (time zone, adaptive execution)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    if spark.sparkContext.master.startswith("local") and spark.conf.get("spark.sql.shuffle.partitions") == "200":
        # One machine with Spark's default: a partition per core; a cluster's own setting is kept.
        spark.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    ``spark.checkpoint.dir`` names it on a cluster. Only a local master may fall back to a
    temporary folder; the choice is kept in the session so one run uses one folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="wattline-")
        spark.conf.set("spark.checkpoint.dir", base)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder name below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives this package to the Python workers of all executors, once for each application.

    The driver serves the file; what was itself started from an archive has been shipped already."""
    context, root = spark.sparkContext, Path(__file__).resolve().parent
    if context.applicationId in _SHIPPED or not root.is_dir():
        return
    archive = os.path.realpath(os.path.join(tempfile.mkdtemp(prefix="wattline-code-"), "wattline.zip"))
    with zipfile.ZipFile(archive, "w") as code:
        for source in sorted(root.rglob("*.py")):
            code.write(source, source.relative_to(root.parent))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


BROADCAST_ROWS = 300_000
BROADCAST_BYTES = 32 << 20


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, where a lost executor cannot take it."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A helper table, computed once and counted: broadcast up to ``max_rows``, else joined by shuffle.

    Spark sizes an aggregate by its input, so without the count it would shuffle the large side.
    """
    kept = settled(df)
    return F.broadcast(kept) if kept.count() <= max_rows else kept
