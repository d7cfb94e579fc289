"""Packing: optimal length buckets from the global histogram, token-budget batches inside each.

Lengths are counted over all documents; there are no more different lengths than tokens in the longest
document. Dynamic programming over their histogram chooses the bucket limits with the least padding of
all. A document longer than the token budget makes a batch of its own. Null and empty texts have length 0
and go to the shortest bucket. Rows without an id and repeated rows are packed like any other. Other
columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattline.llm.common import stored, text_of

BUCKETS = 16
TOKEN_BUDGET = 16_384
#: Rows that are numbered together, and the most such groups in a bucket.
ROWS_NUMBERED, MOST_SHARDS = 20_000, 4_096
PACKED = "doc_id {}, n_tokens long, bucket int, padded_to long, batch_id long, slot int, batch_limit int"


def n_words(docs: DataFrame) -> Column:
    """Words between white space."""
    return F.regexp_count(text_of(docs), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def best_limits(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Bucket limits among ``lengths`` (ascending) with the least total padding."""
    b = len(lengths)
    if not b:
        return []
    n, s = (np.concatenate([[0.0], np.cumsum(x)]) for x in (counts, counts * lengths))
    cost = np.full(b + 1, np.inf)
    cost[0] = 0.0
    came: list[np.ndarray] = []
    for used in range(min(buckets, b)):
        cost, frm = _next_bucket(cost, lengths, n, s, used)
        came.append(frm)
    # Exactly min(buckets, b) buckets: one more never adds padding.
    limits, j = [], b
    for frm in reversed(came):
        limits.append(int(lengths[j - 1]))
        j = int(frm[j])
    return limits[::-1]


def _next_bucket(cost: np.ndarray, lengths: np.ndarray, n: np.ndarray, s: np.ndarray, used: int) -> tuple[np.ndarray, np.ndarray]:
    """Least padding of the first j lengths with one bucket more, for every j, and where that bucket starts.

    The best start never moves back as j grows. So the middle of a range of j is solved first, over the starts that
    remain possible, and parts the starts for both halves; all ranges of one size are solved at once."""
    b = len(lengths)
    new, frm = np.full(b + 1, np.inf), np.zeros(b + 1, dtype=np.int64)
    # Ranges of j, and of starts; with ``used`` buckets before, at least so many lengths lie before.
    low, high, first, last = (np.array([x]) for x in (used + 1, b, used, b - 1))
    while len(low):
        middle = (low + high) // 2
        ends = np.minimum(last, middle - 1)
        sizes = ends - first + 1
        at = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        start = np.repeat(first - at, sizes) + np.arange(sizes.sum())
        j = np.repeat(middle, sizes)
        total = cost[start] + lengths[j - 1] * (n[j] - n[start]) - (s[j] - s[start])
        least = np.minimum.reduceat(total, at)
        hit = np.flatnonzero(total == np.repeat(least, sizes))
        _, pick = np.unique(j[hit], return_index=True)
        best = start[hit[pick]]
        new[middle], frm[middle] = least, best
        halves = [(low, middle - 1, first, best), (middle + 1, high, best, last)]
        low, high, first, last = (np.concatenate([x[k] for x in halves]) for k in range(4))
        order = np.argsort(low, kind="stable")
        keep = order[low[order] <= high[order]]
        low, high, first, last = low[keep], high[keep], first[keep], last[keep]
    return new, frm


def pack(
    docs: DataFrame, length: Column | None = None, buckets: int = BUCKETS, budget: int = TOKEN_BUDGET
) -> DataFrame:
    """One row per document: its length, bucket, padded length, batch (counted in its bucket) and slot.

    A batch of bucket b holds ``batch_limit`` = max(1, budget // padded_to) documents, the last fewer.
    ``length`` gives the number of tokens, null counting as 0. Without it, n_tokens and the budget are in
    words between white space, of which a text in a script without spaces has one.
    """
    n = F.greatest(F.coalesce(length if length is not None else n_words(docs), F.lit(0)).cast("long"), F.lit(0).cast("long"))
    rows = stored(docs.select("doc_id", n.alias("n")).withColumn("row", F.monotonically_increasing_id()), "packing-lengths")
    # A row for each different length.
    got = sorted((r.n, r["count"]) for r in rows.groupBy("n").count().collect())
    total = sum(r[1] for r in got)
    if not total:
        kind = rows.schema["doc_id"].dataType.simpleString()
        return rows.sparkSession.createDataFrame([], PACKED.format(kind))
    limits = best_limits(*(np.array(c, dtype=np.float64) for c in zip(*got, strict=True)), buckets)
    shards = int(min(MOST_SHARDS, -(-total // ROWS_NUMBERED)))
    ends = F.array(*[F.lit(x).cast("long") for x in limits])
    dealt = rows.withColumn("bucket", F.size(F.filter(ends, lambda e: e < F.col("n")))).withColumn(
        "shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")
    )
    # Up to buckets x MOST_SHARDS rows, hence a broadcast of bounded size.
    sizes = dealt.groupBy("bucket", "shard").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("bucket").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("bucket", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("bucket", "shard").orderBy("doc_id", "n", "row")
    at = F.col("offset") + F.row_number().over(within) - 1
    padded = F.element_at(ends, F.col("bucket") + 1)
    limit = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(padded, F.lit(1)))).cast("int")
    return (
        dealt.join(F.broadcast(offsets), ["bucket", "shard"])
        .select("doc_id", "n", "bucket", padded.alias("padded_to"), limit.alias("batch_limit"), at.alias("at"))
        .select(
            "doc_id",
            F.col("n").alias("n_tokens"),
            "bucket",
            "padded_to",
            F.expr("at div batch_limit").alias("batch_id"),
            F.expr("cast(at % batch_limit as int)").alias("slot"),
            "batch_limit",
        )
    )
