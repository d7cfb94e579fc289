"""Helpers shared by the corpus operators."""

from __future__ import annotations

import gc
import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import wattline
from wattline.session import work_path

#: At most so many keys count as hot, so a table of hot keys may be broadcast at any input size.
HOT_KEYS = 5_000
#: No key with fewer rows counts as hot.
HOT_ROWS = 2_000
SPACE = r"[\x20\x09-\x0D]+"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives this package to the Python workers of all executors, once for each application.

    The driver serves the file; what was itself started from an archive has been shipped already."""
    context, root = spark.sparkContext, Path(wattline.__file__).resolve().parent
    if context.applicationId in _SHIPPED or not root.is_dir():
        return
    archive = os.path.realpath(os.path.join(tempfile.mkdtemp(prefix="wattline-code-"), "wattline.zip"))
    with zipfile.ZipFile(archive, "w") as code:
        for source in sorted(root.rglob("*.py")):
            code.write(source, source.relative_to(root.parent))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Paths of stored tables, for as long as their DataFrames are held.
_PATHS: "WeakKeyDictionary[DataFrame, str]" = WeakKeyDictionary()
#: Whether a query's shuffle files go when it has ended, rather than when the driver happens to collect garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows that Spark and a worker hand each other at once.
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def stored(df: DataFrame, name: str, batch: int | None = None) -> DataFrame:
    """``df`` computed once into a table of the shared folder: lineage ends there, no executor holds it alone, and
    the shuffle files it took are not needed any longer. Workers get at most ``batch`` rows at once."""
    spark = df.sparkSession
    path = work_path(spark, name)
    wanted = {CLEANUP: "true"} | ({BATCH: str(batch)} if batch else {})
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
    table = spark.read.schema(df.schema).parquet(path)
    _PATHS[table] = path
    return table


def free(*tables: DataFrame) -> None:
    """Deletes stored tables that nothing reads any longer."""
    for table in tables:
        path = _PATHS.pop(table, None)
        if path:
            context = table.sparkSession.sparkContext
            where = context._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)


def sweep(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of queries that have ended: it does so when the driver's garbage is
    collected, which a driver with little to do puts off while its executors' disks fill."""
    gc.collect()
    spark.sparkContext._jvm.java.lang.System.gc()


def text_of(docs: DataFrame) -> Column:
    """The text, null as empty."""
    return F.coalesce(docs["text"].cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Memo:
    """A dictionary of bounded size: what wasn't asked for while ``size`` other entries came in is forgotten."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def get(self, key):
        found = self.young.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value


#: What this worker keeps from task to task, and what it was made of.
_KEPT: dict[tuple, object] = {}


def keep(make: Callable, *of):
    """``make(*of)``, made once for each worker and kept from task to task until something else is."""
    if (make, *of) not in _KEPT:
        let_go()
        _KEPT[make, *of] = make(*of)
    return _KEPT[make, *of]


def let_go() -> None:
    """Drops what this worker keeps, for tasks that need the memory for something else."""
    _KEPT.clear()


#: Bits of the filter of ``likely``, in bitmaps of Spark's 32,768 bits: 4 MB at any input size.
FILTER_BITS, BITMAP_BITS = 1 << 25, 1 << 15


def likely(rows: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """All ``rows`` whose key is in ``wanted``, and few others: for use before a join that would else
    shuffle wide rows for nothing. A filter of fixed size is broadcast; however many keys there are, no
    row that has a partner is lost, only more of the others pass."""
    bit = F.pmod(F.xxhash64(*keys), F.lit(FILTER_BITS))
    hashed = wanted.select(bit.alias("_bit"))
    maps = hashed.groupBy(F.floor(F.col("_bit") / BITMAP_BITS).alias("_map")).agg(
        F.bitmap_construct_agg(F.col("_bit") % BITMAP_BITS).alias("_bits")
    )
    marked = rows.withColumn("_bit", bit).withColumn("_map", F.floor(F.col("_bit") / BITMAP_BITS))
    joined = marked.join(F.broadcast(stored(maps, "filter")), "_map")
    byte = F.expr("cast(conv(hex(substring(_bits, cast(_bit % 32768 div 8 as int) + 1, 1)), 16, 10) as int)")
    return joined.where(F.getbit(byte, (F.col("_bit") % 8).cast("int")) == 1).select(*rows.columns)


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], spread_by: list[str], how: str = "inner") -> DataFrame:
    """``rows`` with the columns of their group, however many rows one group has.

    ``groups`` holds one stored row per key with its number of rows ``n``. A key above a share of all
    rows is split: its rows get a salt from ``spread_by``, its group row is repeated once per salt.
    As every hot key holds over 1/HOT_KEYS of the rows, there are fewer than HOT_KEYS of them.
    """
    total = groups.agg(F.sum("n")).first()[0] or 0
    limit = max(HOT_ROWS, -(-total // HOT_KEYS))
    parts = F.ceil(F.col("n") / F.lit(limit)).cast("int")
    hot = groups.where(F.col("n") > limit).select(*keys, parts.alias("_parts"))
    salt = F.pmod(F.xxhash64(*spread_by), F.coalesce(F.col("_parts"), F.lit(1))).cast("int")
    salted = rows.join(F.broadcast(hot), keys, "left").withColumn("_salt", salt).drop("_parts")
    copies = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.greatest(parts, F.lit(1)) - 1)))
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")
