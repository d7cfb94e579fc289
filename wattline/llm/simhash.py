"""SimHash near-duplicates by vantage-point trees over fingerprints.

A tree built on a bounded sample cuts the space of fingerprints into shards: at a node, points nearer
to the vantage point than a limit go left, the others right. By the triangle inequality, two points
within the radius lie on both sides only if both are within the radius of the limit; such points are
also sent, as queries, to the shards on the other side. Inside a shard the same splits go on until a
block is small. Where a smallest ratio of set sizes is asked for, a split by size competes with the
vantage points. Shards above the capacity are compared in blocks, so no task holds more.

Neither pairs of equal texts nor all pairs of a dense group are written: every task returns a
spanning forest of the links it has found, shortest links first.

The corpus stage (``drop_near_copies``) takes its first links from fingerprints and tree and checks them
on shingle sets. Similar sets may have far fingerprints; a prefix-filter join finds the pairs that these
links leave apart. Sketches of a few bits a shingle settle most of these pairs, texts are fetched for the rest.

Words are what stands between white space, A-Z lower-cased. Null and empty texts have no words and
fingerprint zero, linked like any other. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.llm.common import free, join_groups, likely, ship, stored, sweep, text_of
from wattline.llm.graph import components

SEED = 42
#: Words of a shingle of the fingerprints, most differing bits of a link.
WORDS, RADIUS = 4, 4
#: Points that the tree is fitted on; all points are routed through it.
SAMPLE, MOST_SHARDS, VANTAGES = 4_096, 4_096, 8
#: Points of a shard, and queries to it, that one task compares.
HOME, QUERIES = 65_536, 65_536
#: Comparisons made at once.
BLOCK = 1 << 20


# ---- fingerprints -------------------------------------------------------------------------


def shingle_hashes(text: str, k: int) -> np.ndarray:
    """XXH64 of every k-word shingle, repeats included; of all words, if fewer; none without words."""
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(words)
    n = max(1, len(words) - k + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    cut = map(slice, starts[:n].tolist(), ends[min(k, len(words)) - 1 :].tolist())
    return np.fromiter(map(xxhash.xxh64_intdigest, map(joined.__getitem__, cut), repeat(SEED)), np.uint64, n)


def mixed(h: np.ndarray, word: int) -> np.ndarray:
    """Further 64-bit hashes from the first: an odd multiple and two shift-xors for each word."""
    if word:
        h = h * np.uint64(0x9E3779B97F4A7C15 + 2 * word)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        h = h ^ (h >> np.uint64(29))
    return h


def fingerprint(h: np.ndarray, words: int) -> bytes:
    """``words`` x 64 bits, big-endian: a bit is 1 if set in over half the hashes."""
    out = []
    for word in range(words):
        bits = np.zeros(64, dtype=np.int64)
        own = mixed(h, word).astype(">u8").view(np.uint8).reshape(-1, 8)
        for i in range(0, len(own), 255):
            bits += np.unpackbits(own[i : i + 255], axis=1).sum(axis=0, dtype=np.uint8)
        out.append(np.packbits(2 * bits > len(h)).tobytes())
    return b"".join(out)


def fingerprints(docs: DataFrame, k: int, words: int) -> DataFrame:
    """doc_id, fp (binary), size (number of different shingles)."""
    ship(docs.sparkSession)
    rows = docs.select("doc_id", text_of(docs).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, sizes = [], []
            for text in batch.column("text"):
                h = shingle_hashes(text.as_py(), k)
                fps.append(fingerprint(h, words))
                sizes.append(len(np.unique(h)))
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(fps, pa.binary()), pa.array(sizes, pa.int32())],
                names=["doc_id", "fp", "size"],
            )

    more = [T.StructField("fp", T.BinaryType()), T.StructField("size", T.IntegerType())]
    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], *more]))


def as_words(fps: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(fps), dtype=">u8").astype(np.uint64).reshape(len(fps), -1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of every row of ``a`` against every row of ``b``."""
    total = np.bitwise_count(a[:, None, 0] ^ b[None, :, 0])
    if a.shape[1] > 1:
        total = total.astype(np.uint16)
        for w in range(1, a.shape[1]):
            total += np.bitwise_count(a[:, None, w] ^ b[None, :, w])
    return total


# ---- the tree -----------------------------------------------------------------------------


class Tree:
    """A vantage-point tree whose leaves are shards, numbered from left to right."""

    def __init__(self, fps: np.ndarray, sizes: np.ndarray, shards: int, radius: int, ratio: float):
        self.radius, self.ratio, self.leaves = radius, ratio, 0
        self.root = self._grow(fps, sizes, shards)

    def _grow(self, fps: np.ndarray, sizes: np.ndarray, shards: int):
        best = self._best(fps, sizes) if shards > 1 and len(fps) > 1 else None
        if best is None:
            self.leaves += 1
            return self.leaves - 1
        left = self._left(best, fps, sizes)[0]
        few = max(1, round(shards * left.mean()))
        more = max(1, shards - few)
        return best, self._grow(fps[left], sizes[left], few), self._grow(fps[~left], sizes[~left], more)

    def _best(self, fps: np.ndarray, sizes: np.ndarray):
        """The split that sends the fewest points to both sides; none, if all would go."""
        splits = []
        for i in np.linspace(0, len(fps) - 1, VANTAGES).astype(int):
            d = distances(fps[i : i + 1], fps)[0].astype(int)
            splits.append((fps[i], int(np.median(d))))
        if self.ratio > 0:
            splits.append((None, int(np.median(sizes))))
        scored = []
        for n, split in enumerate(splits):
            left, to_left, to_right = self._left(split, fps, sizes)
            if left.any() and not left.all():
                scored.append(((to_left & to_right).mean() + abs(left.mean() - 0.5), n))
        if not scored or min(scored)[0] > 0.95:
            return None
        return splits[min(scored)[1]]

    def _left(self, split, fps: np.ndarray, sizes: np.ndarray):
        """At home on the left; may have partners on the left; on the right."""
        vantage, limit = split
        if vantage is None:
            return sizes <= limit, sizes * self.ratio <= limit, sizes > limit * self.ratio
        d = distances(vantage[None], fps)[0].astype(int)
        return d <= limit, d <= limit + self.radius, d > limit - self.radius

    def route(self, fps: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Point, shard, whether at home there. Queries go only to shards right of the home shard: a
        pair is found once, where its right point is at home."""
        found = []

        def walk(node, own: np.ndarray, home: np.ndarray) -> None:
            if not len(own):
                return
            if isinstance(node, int):
                found.append((own, np.full(len(own), node), home))
                return
            split, low, high = node
            left, to_left, to_right = self._left(split, fps[own], sizes[own])
            # A point at home on the left asks on the right; one that only asks may do so on both sides.
            at_low = np.where(home, left, to_left)
            walk(low, own[at_low], home[at_low])
            at_high = to_right | (home & ~left)
            walk(high, own[at_high], (home & ~left)[at_high])

        walk(self.root, np.arange(len(fps)), np.ones(len(fps), dtype=bool))
        if not found:
            return tuple(np.empty(0, dtype=t) for t in (np.int64, np.int64, bool))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


# ---- links inside a task ------------------------------------------------------------------


def forest(n: int, a: np.ndarray, b: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Indices of links that connect what all links connect, shortest first: under ``n`` of them."""
    labels, chosen = np.arange(n), []
    for length in np.unique(d):
        own = np.flatnonzero(d == length)
        while len(own):
            la, lb = labels[a[own]], labels[b[own]]
            own, la, lb = own[la != lb], la[la != lb], lb[la != lb]
            if not len(own):
                break
            # Each label hooks on to a smaller one, by one link: no circles.
            high, first = np.unique(np.maximum(la, lb), return_index=True)
            chosen.append(own[first])
            parent = np.arange(n)
            parent[high] = np.minimum(la, lb)[first]
            while (parent[parent] != parent).any():
                parent = parent[parent]
            labels = parent[labels]
    return np.concatenate(chosen) if chosen else np.empty(0, dtype=np.int64)


class Links:
    """Links found so far, cut back to a spanning forest whenever there are many."""

    def __init__(self, n: int):
        self.n, self.parts, self.count = n, [], 0

    def add(self, a: np.ndarray, b: np.ndarray, d: np.ndarray) -> None:
        self.parts.append((a, b, d))
        self.count += len(a)
        if self.count > max(4 * self.n, 4 * BLOCK):
            self.get()

    def get(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return tuple(np.empty(0, dtype=np.int64) for _ in range(3))
        a, b, d = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        keep = forest(self.n, a, b, d)
        self.parts, self.count = [(a[keep], b[keep], d[keep])], len(keep)
        return self.parts[0]


def near(fps: np.ndarray, sizes: np.ndarray, left: np.ndarray, right: np.ndarray | None, radius: int, ratio: float) -> Links:
    """Links within ``left``, or between ``left`` and ``right`` (indices of points)."""
    links = Links(len(fps))

    def compare(x: np.ndarray, y: np.ndarray, same: bool) -> None:
        step = max(1, BLOCK // max(1, len(y)))
        for i in range(0, len(x), step):
            own = x[i : i + step]
            d = distances(fps[own], fps[y])
            r, c = np.nonzero(d <= radius)
            if same:
                r, c = r[c > r + i], c[c > r + i]
            if ratio > 0:
                sa, sb = sizes[own[r]], sizes[y[c]]
                good = np.minimum(sa, sb) >= ratio * np.maximum(sa, sb)
                r, c = r[good], c[good]
            if len(r):
                links.add(own[r], y[c], d[r, c].astype(np.int64))

    work = [(left, left if right is None else right, right is None)]
    while work:
        x, y, same = work.pop()
        if not len(x) or not len(y):
            continue
        if len(x) * len(y) <= BLOCK:
            compare(x, y, same)
            continue
        if ratio > 0:
            limit = int(np.median(sizes[x]))
            low_x, low_y = sizes[x] <= limit, sizes[y] <= limit
            parts = [(low_x, low_y, same), (~low_x, ~low_y, same)]
            edge_x, edge_y = sizes[x] > ratio * limit, sizes[y] > ratio * limit
            top_x, top_y = sizes[x] * ratio <= limit, sizes[y] * ratio <= limit
            parts.append((low_x & edge_x, ~low_y & top_y, False))
            if not same:
                parts.append((~low_x & top_x, low_y & edge_y, False))
        else:
            vantage = fps[x[len(x) // 2]][None]
            dx, dy = distances(vantage, fps[x])[0].astype(int), distances(vantage, fps[y])[0].astype(int)
            limit = int(np.median(dx))
            low_x, low_y = dx <= limit, dy <= limit
            parts = [(low_x, low_y, same), (~low_x, ~low_y, same)]
            parts.append((low_x & (dx > limit - radius), ~low_y & (dy <= limit + radius), False))
            if not same:
                parts.append((~low_x & (dx <= limit + radius), low_y & (dy > limit - radius), False))
        cost = sum(int(p.sum()) * int(q.sum()) for p, q, _ in parts)
        if cost > 0.9 * len(x) * len(y):
            compare(x, y, same)
        else:
            work += [(x[p], y[q], s) for p, q, s in parts]
    return links


# ---- the join -----------------------------------------------------------------------------


def links(points: DataFrame, radius: int, ratio: float = 0.0, home: int = HOME, queries: int = QUERIES) -> DataFrame:
    """a, size_a, b, size_b, distance: links that connect all points whose fingerprints differ in at
    most ``radius`` bits (and whose smaller size is at least ``ratio`` of the larger).

    ``points`` is a stored table of different (fp, size).
    """
    spark = points.sparkSession
    ship(spark)
    total = points.count()
    # The sample depends on the values alone, so a repeated run builds the same tree.
    sample = points.orderBy(F.xxhash64("fp", "size"), "fp", "size").limit(SAMPLE).collect()
    out = "a binary, size_a int, b binary, size_b int, distance int"
    if not sample:
        return spark.createDataFrame([], out)
    tree = Tree(
        as_words([bytes(r.fp) for r in sample]),
        np.array([r["size"] for r in sample]),
        min(MOST_SHARDS, -(-total // home)),
        radius,
        ratio,
    )
    sent = spark.sparkContext.broadcast(tree)  # at most MOST_SHARDS - 1 nodes

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            fps = as_words(batch.column("fp").to_pylist())
            own, shard, at_home = sent.value.route(fps, batch.column("size").to_numpy())
            for i in range(0, len(own), BLOCK):
                part = batch.take(pa.array(own[i : i + BLOCK]))
                yield pa.record_batch(
                    [
                        pa.array(shard[i : i + BLOCK], pa.int32()),
                        pa.array(at_home[i : i + BLOCK]),
                        part.column("fp"),
                        part.column("size"),
                    ],
                    names=["shard", "home", "fp", "size"],
                )

    routed = points.select("fp", "size").mapInArrow(route, "shard int, home boolean, fp binary, size int")
    routed = stored(routed, "simhash-routed")
    # At most two rows for each shard.
    counted = {(r.shard, r.home): r["count"] for r in routed.groupBy("shard", "home").count().collect()}
    blocks = spark.createDataFrame(
        [
            (s, -(-counted[s, True] // home), -(-counted.get((s, False), 0) // queries))
            for s in range(tree.leaves)
            if (s, True) in counted
        ],
        "shard int, homes int, asked int",
    )
    placed = routed.join(F.broadcast(blocks), "shard")
    own = F.pmod(F.xxhash64("fp", "size"), F.when(F.col("home"), F.col("homes")).otherwise(F.col("asked"))).cast("int")
    # Tasks (shard, i, j): home block i with home block j >= i, or with query block j - homes.
    at_home = F.transform(
        F.sequence(F.lit(0), F.col("homes") + F.col("asked") - 1),
        lambda j: F.struct(
            F.when(j < F.col("homes"), F.least(j, F.col("own"))).otherwise(F.col("own")).alias("i"),
            F.when(j < F.col("homes"), F.greatest(j, F.col("own"))).otherwise(j).alias("j"),
            ((j < F.col("homes")) & (j < F.col("own"))).alias("second"),
        ),
    )
    asking = F.transform(
        F.sequence(F.lit(0), F.col("homes") - 1),
        lambda i: F.struct(i.alias("i"), (F.col("homes") + F.col("own")).alias("j"), F.lit(True).alias("second")),
    )
    tasks = placed.withColumn("own", own).withColumn(
        "task", F.explode(F.when(F.col("home"), at_home).otherwise(asking))
    )

    def compare(table: pa.Table) -> pa.Table:
        fp = table.column("fp").to_pylist()
        fps, sizes = as_words(fp), table.column("size").to_numpy()
        second = table.column("second").to_numpy()
        alone = table.column("i")[0].as_py() == table.column("j")[0].as_py()
        x, y = np.flatnonzero(~second), None if alone else np.flatnonzero(second)
        a, b, d = near(fps, sizes, x, y, radius, ratio).get()
        return pa.table(
            {
                "a": pa.array([fp[i] for i in a], pa.binary()),
                "size_a": pa.array(sizes[a], pa.int32()),
                "b": pa.array([fp[i] for i in b], pa.binary()),
                "size_b": pa.array(sizes[b], pa.int32()),
                "distance": pa.array(d, pa.int32()),
            }
        )

    flat = tasks.select("shard", "task.*", "fp", "size")
    return flat.groupBy("shard", "i", "j").applyInArrow(compare, out)


def _prints(docs: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """doc_id, fp of every document; fp, n, low (smallest doc_id) of every fingerprint."""
    prints = stored(fingerprints(docs, k, 1).select("doc_id", "fp"), "simhash-prints")
    return prints, stored(prints.groupBy("fp").agg(F.count("*").alias("n"), F.min("doc_id").alias("low")), "simhash-distinct")


def near_groups(docs: DataFrame, k: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id of all
    documents that links of at most ``radius`` differing bits reach, itself included).

    Rows without an id take part; a component in which no row has one has a null component_id.
    """
    prints, distinct = _prints(docs, k)
    found = links(distinct.select("fp", F.lit(0).alias("size")), radius)
    roots = components(found.select("a", "b"))
    rooted = stored(
        distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")),
        "simhash-roots",
    )
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"), F.count("*").alias("n"))
    named = join_groups(
        rooted.select("fp", "root", F.col("n").alias("rows")), stored(lowest, "simhash-lowest"), ["root"], ["fp"]
    )
    groups = stored(named.select("fp", F.col("rows").alias("n"), "component_id"), "simhash-groups")
    return join_groups(prints, groups, ["fp"], ["doc_id"]).select(
        "doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id"
    )


# ---- the corpus stage ---------------------------------------------------------------------

#: Words of a shingle, least share of common shingles.
SHINGLE, SIMILARITY = 5, 0.8
#: About so many texts show which shingles are common; the most of those that are broadcast.
COMMON_TEXTS, MOST_COMMON = 8_192, 500_000
#: Members of a group that one task compares with all others.
MEMBERS = 200


def shingle_set(text: str, k: int) -> np.ndarray:
    """The different shingle hashes, ascending; none without words."""
    return np.unique(shingle_hashes(text, k))


def least_common(size: int, similarity: float) -> int:
    """Fewest shingles that a set of ``size`` has in common with any similar set."""
    return int(np.ceil(similarity * size - 1e-9))


def sketch(own: np.ndarray) -> bytes:
    """Of each bit, whether an odd number of the different hashes ``own`` fall on it: two to four bits a hash.

    What two sets have in common cancels out, so their sketches differ in no more bits than the sets in hashes."""
    bits = max(64, 1 << int(2 * len(own) - 1).bit_length() if len(own) else 0)
    odd = np.bincount((own.view(np.uint64) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def sketches_differ(s: bytes, t: bytes) -> int:
    """Differing bits; a longer sketch is folded to the length of the other, which leaves the bound as it is."""
    a, b = int.from_bytes(s, "little"), int.from_bytes(t, "little")
    n, m = 8 * len(s), 8 * len(t)
    while n > m:
        n //= 2
        a = (a >> n) ^ (a & ((1 << n) - 1))
    while m > n:
        m //= 2
        b = (b >> m) ^ (b & ((1 << m) - 1))
    return (a ^ b).bit_count()


def _common_shingles(docs: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, ascending, of shingles that several of a sample of texts hold, and how many do.

    They only order the shingles of a set, so results do not depend on the sample."""
    rate = max(1, docs.count() // COMMON_TEXTS)
    some = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(rate)) == 0).select(text_of(docs).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("text"):
                yield pa.record_batch([pa.array(shingle_set(text.as_py(), k).view(np.int64))], names=["tok"])

    counted = some.mapInArrow(run, "tok long").groupBy("tok").agg(F.count("*").alias("n")).where("n > 2")
    got = counted.orderBy(F.desc("n"), "tok").limit(MOST_COMMON).toPandas().sort_values("tok")
    return got["tok"].to_numpy(np.int64), got["n"].to_numpy(np.int64)


def _prefixes(docs: DataFrame, k: int, similarity: float) -> DataFrame:
    """tok, id, size, at: the rarest shingles of each set, with their places in the order of rarity; at place 0 also
    the sketch of the set, else null.

    All sets are ordered alike. Two similar sets have at least ``least_common`` shingles in common, so
    each has one of these among its first size - least_common + 1: similar sets always share a row."""
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(_common_shingles(docs, k))
    rows = docs.select(F.col("doc_id").alias("id"), text_of(docs).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = sent.value
        for batch in batches:
            toks, sizes, ats, take, sketches = [], [], [], [], []
            for i, text in enumerate(batch.column("text")):
                own = shingle_set(text.as_py(), k).view(np.int64)
                n, drawn = len(own), sketch(own)
                if not n:  # sets without shingles meet at a token of their own
                    own = np.zeros(1, dtype=np.int64)
                elif len(known):
                    place = np.minimum(np.searchsorted(known, own), len(known) - 1)
                    often = np.where(known[place] == own, counts[place], 0)
                    own = own[np.lexsort((own, often))]
                own = own[: n - least_common(n, similarity) + 1]
                toks.append(own)
                sizes.append(np.full(len(own), n, dtype=np.int32))
                ats.append(np.arange(len(own), dtype=np.int32))
                take.append(np.full(len(own), i, dtype=np.int64))
                sketches += [drawn, *[None] * (len(own) - 1)]
            if toks:
                yield pa.record_batch(
                    [
                        pa.array(np.concatenate(toks)),
                        batch.column("id").take(pa.array(np.concatenate(take))),
                        pa.array(np.concatenate(sizes)),
                        pa.array(np.concatenate(ats)),
                        pa.array(sketches, pa.binary()),
                    ],
                    names=["tok", "id", "size", "at", "sketch"],
                )

    more = [T.StructField("size", T.IntegerType()), T.StructField("at", T.IntegerType()), T.StructField("sketch", T.BinaryType())]
    return rows.mapInArrow(run, T.StructType([T.StructField("tok", T.LongType()), rows.schema["id"], *more]))


def _possible(other: str, similarity: float) -> Column:
    """False only if the places of the shared shingle leave too few others to be in common."""
    size, at = F.col(f"{other}.size"), F.col(f"{other}.at")
    most = F.least("at", at) + 1 + F.least(F.col("size") - F.col("at"), size - at) - 1
    wanted = F.col("size") + size
    return ((wanted == 0) | (most * (1 + similarity) >= similarity * wanted - 1e-6)) & (
        F.least("size", size) >= similarity * F.greatest("size", size) - 1e-6
    )


def _alike(similarity: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Passes all pairs of similar sets: of x and y hashes, these differ in (x + y)(1 - similarity)/(1 + similarity) at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size_a").to_numpy().astype(np.int64) + batch.column("size_b").to_numpy()
            pairs = zip(batch.column("sketch_a").to_pylist(), batch.column("sketch_b").to_pylist(), strict=True)
            differ = np.fromiter((sketches_differ(s, t) for s, t in pairs), np.int64, batch.num_rows)
            keep = differ * (1 + similarity) <= sizes * (1 - similarity) + 1e-6
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _possible_pairs(pairs: DataFrame, sketches: DataFrame, similarity: float) -> DataFrame:
    """Those of the stored ``pairs`` (a, b) that ``sketches`` (a, size, sketch) do not show to be unlike. A sketch takes
    a quarter to half a byte for each of a text's shingles, so few texts need be sent for the exact check."""
    ends = pairs.select("a").unionByName(pairs.select(F.col("b").alias("a")))
    involved = stored(ends.groupBy("a").agg(F.count("*").alias("n")), "near-involved")
    drawn = stored(likely(sketches, involved, ["a"]).join(involved, "a").select("a", "size", "sketch", "n"), "near-drawn")
    left = join_groups(pairs, drawn.toDF("a", "size_a", "sketch_a", "n"), ["a"], ["b"]).drop("n")
    both = join_groups(left, drawn.toDF("b", "size_b", "sketch_b", "n"), ["b"], ["a"]).drop("n")
    kind = pairs.schema["a"].dataType.simpleString()
    possible = stored(both.mapInArrow(_alike(similarity), f"a {kind}, b {kind}").distinct(), "near-possible")
    free(involved, drawn)
    return possible


def _similar(k: int, similarity: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, last, own = [], None, None
            for s, t in zip(batch.column("text_a"), batch.column("text_b"), strict=True):
                s = s.as_py()
                if s != last:
                    last, own = s, shingle_set(s, k)
                other = shingle_set(t.as_py(), k)
                common = len(np.intersect1d(own, other, assume_unique=True))
                keep.append(common >= similarity * (len(own) + len(other) - common) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _verified(pairs: DataFrame, docs: DataFrame, k: int, similarity: float) -> DataFrame:
    """Those of the stored ``pairs`` (a, b) whose texts are similar."""
    ends = pairs.select("a").unionByName(pairs.select(F.col("b").alias("a")))
    involved = stored(ends.groupBy("a").agg(F.count("*").alias("n")), "near-involved")
    named = docs.select(F.col("doc_id").alias("a"), text_of(docs).alias("text"))
    texts = stored(likely(named, involved, ["a"]).join(involved, "a"), "near-texts")
    left = join_groups(pairs, texts.withColumnRenamed("text", "text_a"), ["a"], ["b"]).select("a", "b", "text_a")
    both = join_groups(left, texts.toDF("b", "text_b", "n"), ["b"], ["a"]).select("a", "b", "text_a", "text_b")
    kind = docs.schema["doc_id"].dataType.simpleString()
    good = stored(both.mapInArrow(_similar(k, similarity), f"a {kind}, b {kind}"), "near-verified")
    free(involved, texts)
    sweep(docs.sparkSession)
    return good


def _close_pairs(docs: DataFrame) -> DataFrame:
    """a, b: the documents, by their ids, that links of the tree between fingerprints connect. Of documents with one
    fingerprint, the others are linked to the smallest id, which stands for them in links to other fingerprints."""
    prints, distinct = _prints(docs, WORDS)
    found = stored(links(distinct.select("fp", F.lit(0).alias("size")), RADIUS).select("a", "b"), "simhash-links")
    ends = found.select(F.col("a").alias("fp")).unionByName(found.select(F.col("b").alias("fp"))).groupBy("fp").agg(F.count("*").alias("n"))
    named = stored(ends.join(distinct.select("fp", "low"), "fp"), "simhash-ends")
    left = join_groups(found, named.toDF("a", "n", "low_a"), ["a"], ["b"]).select("a", "b", "low_a")
    both = join_groups(left, named.toDF("b", "n", "low_b"), ["b"], ["a"])
    several = distinct.where("n > 1")
    same = join_groups(likely(prints, several, ["fp"]), several, ["fp"], ["doc_id"]).where(F.col("doc_id") != F.col("low"))
    pairs = both.select(F.col("low_a").alias("a"), F.col("low_b").alias("b")).unionByName(
        same.select(F.col("low").alias("a"), F.col("doc_id").alias("b"))
    )
    pairs = _new_pairs(pairs.where("a <> b"), None)
    free(prints, distinct, found, named)
    sweep(docs.sparkSession)
    return pairs


def _open_groups(shared: DataFrame, good: DataFrame, *more: Column) -> tuple[DataFrame, DataFrame]:
    """Rows with their root, and the groups of a token that verified links have not yet made one, with ``more`` of each."""
    roots = components(good)
    rooted = shared.drop("root").join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    rooted = stored(rooted, "near-rooted")
    free(roots)
    groups = rooted.groupBy("tok").agg(
        F.count("*").alias("n"), F.min("root").alias("_least"), F.max("root").alias("_most"), *more
    )
    groups = stored(groups.where("_least <> _most").drop("_least", "_most"), "near-open")
    return rooted, groups


def _new_pairs(pairs: DataFrame, checked: DataFrame | None) -> DataFrame:
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return stored(pairs if checked is None else pairs.join(checked, ["a", "b"], "left_anti"), "near-pairs")


def drop_near_copies(docs: DataFrame, k: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """The documents, in all their columns, without near copies: of each group the smallest id stays.

    Groups are what links connect; a link is a pair whose k-word shingle sets have at least
    ``similarity`` of their union in common. Pairs with near fingerprints (see ``links``) are compared
    first. Similar sets share one of their rarest shingles (see ``_prefixes``). Of the documents with one
    such shingle that are not yet one group, all are compared with the one of smallest id, then with
    another, and at last all pairs that are still in different groups: every possible pair is verified,
    connected by verified links, or unlike by its sketches.
    Rows without an id stay. Rows that share an id are one document and stay or go together.
    """
    with_id = docs.where(F.col("doc_id").isNotNull())
    checked = _close_pairs(with_id)
    good = _verified(checked, with_id, k, similarity)

    drawn = stored(_prefixes(with_id, k, similarity), "near-prefixes")
    sketches = stored(drawn.where(F.col("sketch").isNotNull()).select(F.col("id").alias("a"), "size", "sketch"), "near-sketches")
    rows = drawn.drop("sketch")
    groups = stored(rows.groupBy("tok").agg(F.count("*").alias("n")).where("n > 1"), "near-groups")
    shared = stored(join_groups(likely(rows, groups, ["tok"]), groups, ["tok"], ["id"]).drop("n"), "near-shared")
    free(drawn, groups)

    member = F.struct("id", "size", "at", "root")
    for leader in (F.min(member), F.min_by(member, F.xxhash64("tok", "id"))):
        rooted, groups = _open_groups(shared, good, leader.alias("lead"))
        free(shared)
        led = join_groups(rooted, groups, ["tok"], ["id"])
        apart = led.where((F.col("root") != F.col("lead.root")) & _possible("lead", similarity))
        pairs = _new_pairs(apart.select(F.col("lead.id").alias("a"), F.col("id").alias("b")), checked)
        checked = checked.unionByName(pairs)
        possible = _possible_pairs(pairs, sketches, similarity)
        good = good.unionByName(_verified(possible, with_id, k, similarity))
        free(possible)
        # Groups of two are settled.
        shared = stored(led.where("n > 2").select("tok", "id", "size", "at"), "near-shared")
        free(rooted, groups)

    rooted, groups = _open_groups(shared, good)
    free(shared)
    if not groups.isEmpty():
        parts = F.ceil(F.col("n") / MEMBERS).cast("int")
        salted = join_groups(rooted, groups, ["tok"], ["id"]).withColumn("salt", F.pmod(F.xxhash64("id"), parts))
        every = join_groups(rooted, groups, ["tok"], ["id"]).withColumn(
            "salt", F.explode(F.sequence(F.lit(0).cast("long"), parts.cast("long") - 1))
        )
        others = every.select("tok", "salt", F.struct("id", "size", "at", "root").alias("other"))
        apart = salted.join(others, ["tok", "salt"]).where(
            (F.col("id") < F.col("other.id")) & (F.col("root") != F.col("other.root")) & _possible("other", similarity)
        )
        pairs = _new_pairs(apart.select(F.col("id").alias("a"), F.col("other.id").alias("b")), checked)
        possible = _possible_pairs(pairs, sketches, similarity)
        good = good.unionByName(_verified(possible, with_id, k, similarity))
        free(pairs, possible)
    free(rooted, groups, sketches)
    roots = components(good)
    gone = roots.where("node <> root").select(F.col("node").alias("doc_id"))
    return docs.join(gone, "doc_id", "left_anti").select(*[docs[c] for c in docs.columns])
