"""Exact de-duplication: group by 128-bit content hash, compare the texts' bytes, keep the smallest id.

Two texts are equal when they are identical once each run of white space is one space. Null counts
as empty, and empty texts are equal to each other. Rows without an id form groups like any other; an
id beats no id. Rows that repeat one id and text are one document: each gets the same answer in
``exact_groups``, and ``drop_exact_copies`` keeps one of them. Only ``doc_id`` and ``text`` are read,
so other columns may have any name.

Only hashes and ids are shuffled for grouping. The texts of groups with more than one row move once
more, to be compared: the smallest and the largest text of a group are equal exactly if all are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import SPACE, join_groups, likely, stored, text_of

Digest = Callable[[Column], Column]


def content_hash(text: Column) -> Column:
    """128 bits."""
    return F.unhex(F.md5(text))


def normalised(docs: DataFrame) -> Column:
    return F.regexp_replace(text_of(docs), SPACE, " ")


def _groups(docs: DataFrame, digest: Digest) -> tuple[DataFrame, DataFrame]:
    """Keys (doc_id, h, v, sha) of all rows and the stored groups (h, v, n, keep_id, n_keep).

    ``v`` is null, except in groups in which different texts share a hash: there it is the text.
    """
    rows = docs.select(F.col("doc_id"), normalised(docs).alias("norm"))
    hashed = rows.withColumn("h", digest(F.col("norm")))
    keys = stored(hashed.select("doc_id", "h", F.unhex(F.sha2("norm", 256)).alias("sha")), "exact-keys")

    def summed(df: DataFrame, by: list[str]) -> DataFrame:
        ids = df.groupBy(*by, "doc_id").agg(F.count("*").alias("n"))
        first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "n"))
        return ids.groupBy(*by).agg(F.sum("n").alias("n"), first.alias("first")).select(
            *by, "n", F.col("first.doc_id").alias("keep_id"), F.col("first.n").alias("n_keep")
        )

    plain = stored(summed(keys, ["h"]), "exact-groups")
    several = plain.where("n > 1").select("h", "n")
    suspects = join_groups(likely(hashed, several, ["h"]), several, ["h"], ["doc_id"])
    mixed = stored(
        suspects.groupBy("h").agg(F.min("norm").alias("lo"), F.max("norm").alias("hi")).where("lo <> hi").select("h"),
        "exact-mixed",
    )
    none = F.lit(None).cast("string").alias("v")
    if mixed.isEmpty():
        return keys.withColumn("v", none), plain.withColumn("v", none)
    # Different texts under one hash: there the text itself is the key.
    apart = hashed.join(mixed.withColumn("v_is_text", F.lit(True)), "h", "left").withColumn(
        "v", F.when(F.col("v_is_text"), F.col("norm"))
    )
    keys = stored(apart.select("doc_id", "h", "v", F.unhex(F.sha2("norm", 256)).alias("sha")), "exact-keys")
    return keys, stored(summed(keys, ["h", "v"]), "exact-groups")


def _joined(rows: DataFrame, groups: DataFrame) -> DataFrame:
    marked = [F.coalesce(F.concat(F.lit("="), F.col("v")), F.lit("")).alias("v")]
    rows = rows.select(*[c for c in rows.columns if c != "v"], *marked)
    groups = groups.select(*[c for c in groups.columns if c != "v"], *marked)
    return join_groups(rows, groups, ["h", "v"], ["doc_id"])


def exact_groups(docs: DataFrame, digest: Digest = content_hash) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    keys, groups = _groups(docs, digest)
    return _joined(keys, groups).select(
        "doc_id",
        "keep_id",
        F.col("n").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, digest: Digest = content_hash) -> DataFrame:
    """The documents, in all their columns, without copies of others."""
    keys, groups = _groups(docs, digest)
    mixed = groups.where("v is not null").select("h").distinct().withColumn("apart", F.lit(True))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), "doc_id", normalised(docs).alias("norm"))
    rows = rows.withColumn("h", digest(F.col("norm"))).join(mixed, "h", "left")
    rows = rows.select("row", "doc_id", "h", F.when(F.col("apart"), F.col("norm")).alias("v"))
    kept = _joined(rows, groups).where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    single = kept.where("n_keep = 1").select("row")
    repeated = kept.where("n_keep > 1").dropDuplicates(["h", "v"]).select("row")
    return single.unionByName(repeated).select("row.*")
