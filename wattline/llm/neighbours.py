"""Nearest neighbours by inner product with multi-index hashing.

Vectors are rotated by learned rotations and their signs make binary codes, which are split into
substrings. For a radius R over m substrings, a code within R of a query has a substring within
R // m of the query's, so probing those entries of every substring's table returns all codes within
R; they are ranked again by the inner product of the original vectors, in double precision.

Rotations and the radius are learned on a bounded sample: in n vectors a query's k nearest lie where the
sample has its nearest k·sample/n. All vectors are indexed. Where probing reaches most of a block, all its
codes are compared instead, which gives the same. A query with fewer than k answers from all blocks
together is searched again without a radius, so nothing is cut off. Vectors and queries meet in blocks
of bounded size: each task indexes one block of vectors and answers one block of queries.

Null or zero vectors, vectors with null or non-finite components, and vectors without an id take no
part. Vectors of another length than the most frequent one raise. Rows that share an id are candidates
each, so an id may fill several places, but a row fills one: a query with such an id gets the best rows
that any of its own rows has, each with its highest score. A query's own id never answers it. Only
``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattline.llm.common import ship, stored

#: Neighbours of a query; every such-and-such id is a query.
NEIGHBOURS, EVERY = 20, 20
#: Vectors the code is learned on, and those of them that serve as queries to learn the radius.
SAMPLE, PROBES = 8_192, 256
#: Rotations (each gives a bit for each dimension), bits of a substring, share of true neighbours aimed at.
ROTATIONS, SUBSTRING, RECALL = 8, 8, 0.98
#: Vectors and queries of a task.
BLOCK, ASKED = 8_192, 2_048


class Code:
    """Binary codes of vectors: centred, scaled to one length, rotated, signs."""

    def __init__(self, sample: np.ndarray, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.longest = float(np.sqrt((sample**2).sum(axis=1).max())) if len(sample) else 1.0
        lifted = self._lift(sample)
        self.mean = lifted.mean(axis=0) if len(lifted) else np.zeros(lifted.shape[1])
        centred = lifted - self.mean
        self.rotations = [self._rotation(centred, rng) for _ in range(ROTATIONS)]

    def _lift(self, x: np.ndarray) -> np.ndarray:
        """One more component gives all vectors one length, so that near means a large inner product.
        Longer vectors than the sample's longest get none."""
        rest = np.sqrt(np.maximum(self.longest**2 - (x**2).sum(axis=1, keepdims=True), 0.0))
        return np.hstack([x, rest])

    @staticmethod
    def _rotation(x: np.ndarray, rng: np.random.Generator, rounds: int = 10) -> np.ndarray:
        """Alternates the nearest signs and the rotation that brings the data nearest to them."""
        rotation = np.linalg.qr(rng.standard_normal((x.shape[1],) * 2))[0]
        for _ in range(rounds if len(x) else 0):
            u, _, v = np.linalg.svd(x.T @ np.sign(x @ rotation))
            rotation = u @ v
        return rotation

    def bits(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """Packed codes, padded to whole substrings."""
        lifted = np.hstack([x, np.zeros((len(x), 1))]) if query else self._lift(x)
        if query:  # a query's length doesn't change its order of vectors
            lifted *= self.longest / np.maximum(np.sqrt((x**2).sum(axis=1, keepdims=True)), 1e-300)
        signs = np.hstack([(lifted - self.mean) @ r > 0 for r in self.rotations])
        return np.packbits(signs, axis=1)


def distances(codes: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Differing bits of codes from one; of bytes, or of the words of ``words``."""
    return np.bitwise_count(codes ^ code).sum(axis=1, dtype=np.int64)


def words(codes: np.ndarray) -> np.ndarray:
    """Codes as 64-bit words, a word to a row, so that a pass over one reads neighbouring memory."""
    padded = np.zeros((len(codes), -(-codes.shape[1] // 8) * 8), dtype=np.uint8)
    padded[:, : codes.shape[1]] = codes
    return np.ascontiguousarray(padded.view(np.uint64).T)


def products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products; equal vectors get equal ones wherever they stand, as no matrix product promises."""
    return (vectors * query).sum(axis=1)


class MultiIndex:
    """Tables from each substring's values to the vectors that have them."""

    def __init__(self, codes: np.ndarray, radius: int):
        self.codes, self.radius = codes, radius
        self.words = words(codes)
        self.each = radius // codes.shape[1]
        self.orders = [np.argsort(codes[:, s], kind="stable") for s in range(codes.shape[1])]
        values = np.arange(257)
        self.starts = [np.searchsorted(codes[o, s], values) for s, o in enumerate(self.orders)]
        apart = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8))
        self.probes = [np.flatnonzero(row <= self.each) for row in apart]
        self.entries: dict[tuple[int, int], np.ndarray] = {}

    def near(self, s: int, value: int) -> np.ndarray:
        """Positions whose substring ``s`` is within reach of a value: looked up once for all queries that have it."""
        found = self.entries.get((s, value))
        if found is None:
            order, starts = self.orders[s], self.starts[s]
            found = np.concatenate([order[starts[p] : starts[p + 1]] for p in self.probes[value]])
            self.entries[s, value] = found
        return found

    def within(self, code: np.ndarray) -> np.ndarray:
        """Positions of all codes within the radius, ascending."""
        found, reached = np.zeros(len(self.codes), dtype=bool), 0
        for s, value in enumerate(code.tolist()):
            entries = self.near(s, value)
            found[entries] = True
            reached += len(entries)
            if reached > len(found):  # probing on would find most of the block
                return np.flatnonzero(self.all_distances(code) <= self.radius)
        own = np.flatnonzero(found)
        return own[distances(self.codes[own], code) <= self.radius]

    def all_distances(self, code: np.ndarray) -> np.ndarray:
        total = np.zeros(len(self.codes), np.uint16)
        for row, word in zip(self.words, words(code[None])[:, 0], strict=True):
            total += np.bitwise_count(row ^ word)
        return total


def learned_radius(code: Code, sample: np.ndarray, k: int, total: int | None = None) -> int:
    """The radius that holds RECALL of the true neighbours, of whose ``k`` in ``total`` vectors the sample has its share."""
    far = []
    codes = code.bits(sample)
    share = len(sample) / max(total or 0, len(sample), 1)
    k = min(max(1, int(np.ceil(k * share))), max(0, len(sample) - 1))
    for i in np.linspace(0, len(sample) - 1, min(PROBES, len(sample))).astype(int):
        score = products(sample, sample[i])
        score[i] = -np.inf
        best = np.argsort(-score, kind="stable")[:k]
        far.append(distances(codes[best], code.bits(sample[i : i + 1], query=True)[0]))
    joined = np.concatenate(far) if far else np.empty(0)
    return int(np.quantile(joined, RECALL)) if len(joined) else 0


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def nearest(vectors: DataFrame, k: int = NEIGHBOURS, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` nearest vectors of each query, nearest first.

    Queries are the rows whose vec_id is divisible by ``every``. Ties go to the smaller vec_id.
    """
    spark = vectors.sparkSession
    ship(spark)
    values = F.transform("embedding", lambda v: v.cast("double"))
    usable = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    good = vectors.where(F.col("vec_id").isNotNull() & F.coalesce(usable, F.lit(False)))
    good = good.where(F.exists("embedding", lambda v: v != 0)).select(F.col("vec_id").cast("long").alias("vec_id"), values.alias("v"))
    rows = stored(good.withColumn("row", F.monotonically_increasing_id()), "vectors")
    out = "query_id long, rank int, vec_id long, score double"
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(2).collect()
    if len(lengths) > 1:
        raise ValueError(f"vectors of {lengths[0].n} and of {lengths[1].n} components")
    if not lengths:
        return spark.createDataFrame([], out)
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toArrow()
    sample = _matrix(picked.column("v"))
    code = Code(sample)
    asked = F.col("vec_id") % every == 0
    total, queries = rows.agg(F.count("*"), F.count_if(asked)).first()
    sent = spark.sparkContext.broadcast((code, learned_radius(code, sample, k, total)))
    blocks = max(1, -(-total // BLOCK))
    place = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def search(asking: DataFrame, n: int, limited: bool) -> DataFrame:
        """query_id, row, vec_id, score of the best rows of each block, within the radius if ``limited``."""
        parts = max(1, -(-n // ASKED))
        own = rows.select(place(blocks).alias("block"), numbers(parts).alias("part"), F.lit(False).alias("asks"), "row", "vec_id", "v")
        its = asking.select(numbers(blocks).alias("block"), place(parts).alias("part"), F.lit(True).alias("asks"), "row", "vec_id", "v")
        met = own.unionByName(its).groupBy("block", "part").applyInArrow(
            _answer(sent, k, limited), "query_id long, row long, vec_id long, score double"
        )
        # Query rows that share an id may each have found a row.
        return stored(met.groupBy("query_id", "row", "vec_id").agg(F.max("score").alias("score")), "near-rows")

    asking = rows.where(asked)
    found = search(asking, queries, True)
    few = asking.select("vec_id").distinct().join(
        found.groupBy(F.col("query_id").alias("vec_id")).agg(F.count("*").alias("n")), "vec_id", "left"
    ).where(F.coalesce("n", F.lit(0)) < k).select("vec_id")
    few = stored(few, "near-few")
    if not few.isEmpty():
        again = asking.join(few, "vec_id", "left_semi")
        rest = found.join(few.withColumnRenamed("vec_id", "query_id"), "query_id", "left_anti")
        found = rest.unionByName(search(again, again.count(), False))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _answer(sent, k: int, limited: bool):
    def answer(table: pa.Table) -> pa.Table:
        model, radius = sent.value
        asks = table.column("asks").to_numpy()
        numbers, ids, x = table.column("row").to_numpy(), table.column("vec_id").to_numpy(), _matrix(table.column("v"))
        row, own, held = numbers[~asks], ids[~asks], x[~asks]
        columns = [[], [], [], []]
        if len(own) and asks.any():
            index = MultiIndex(model.bits(held), radius) if limited else None
            for query_id, q, bits in zip(ids[asks], x[asks], model.bits(x[asks], query=True), strict=True):
                at = index.within(bits) if index else np.arange(len(own))
                at = at[own[at] != query_id]
                score = products(held[at], q)
                best = np.lexsort((own[at], -score))[:k]
                columns[0].append(np.full(len(best), query_id))
                columns[1].append(row[at][best])
                columns[2].append(own[at][best])
                columns[3].append(score[best])
        kinds = {"query_id": pa.int64(), "row": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()}
        parts = [np.concatenate(c) if c else np.empty(0) for c in columns]
        return pa.table({n: pa.array(p).cast(t) for (n, t), p in zip(kinds.items(), parts, strict=True)})

    return answer
