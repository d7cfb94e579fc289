"""Trie of conversation prefixes.

A node is a distinct sequence of the first d turns, a turn being its role and text; the root is the empty
sequence. Sequences of turn ids are dealt to shards by range, so a node's sequences lie side by side. A
shard sorts them as padded matrices of turn ids, in bands of columns; where a column or one before it
changes from a row to the next, a node starts, and sums over rows from start to start describe all nodes of
that depth. A node that may reach beyond its shard leaves it as a part; parts of one node are put together
by the digest of its sequence. Sums over subtrees come from child to parent inside a shard, and by doubling
steps between the few nodes that several shards share.

Texts stay where they are: a turn is known by 128 bits of the SHA-256 of its role and text and by its
length. A conversation's ids, 24 bytes a turn, are held by one task; bands keep long conversations from
padding the others.

Null roles and texts become empty. Turns are in the order of ``turn``, nulls first; equal ones are in the order
of their ids, and repeated rows are turns of their own. Rows without a conversation belong to none. An
empty table has no nodes. Other columns than conv_id, turn, role and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import join_groups, ship, stored

#: Turns of a shard, about; conversations without turns count as one.
SHARD_TURNS = 250_000
#: First turns by which conversations are dealt to shards.
RANGE_TURNS = 16
#: Columns of a padded matrix at most, and of the first.
BAND, FIRST_BAND = 256, 8
#: Conversation ids in one row of a list.
IDS = 8_192
NODE = (
    "key binary, parent binary, conv_id long, parent_conv_id long, depth long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, length long, ends_sha256 string, ids string, open boolean"
)
ROOT = b"\0" * 16


def sequences(turns: DataFrame) -> DataFrame:
    """conv_id and its turns (hi, lo, length) in order, of rows (conv_id, turn, role, text)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    # The role's length in front keeps (role, text) pairs apart.
    digest = F.sha2(F.concat_ws(":", F.octet_length(role), F.concat(role, text)), 256)
    half = [F.conv(F.substring(digest, 1 + 16 * i, 16), 16, -10).cast("long") for i in range(2)]
    turn = F.struct(
        F.col("turn").alias("turn"), half[0].alias("hi"), half[1].alias("lo"), F.length(text).cast("long").alias("length")
    )
    rows = turns.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    ordered = F.array_sort(F.collect_list("t"))
    return rows.groupBy("conv_id").agg(
        F.transform(ordered, lambda t: F.struct(t["hi"].alias("hi"), t["lo"].alias("lo"), t["length"].alias("length"))).alias("turns")
    )


def rebuilt(own: DataFrame, every: int = 100, shared: int = 6) -> DataFrame:
    """Conversations that start with the first h turns of another: conversation c with those of
    c - c % ``every``, in place of its own, h being crc32 of c's decimal form modulo ``shared``."""
    base = F.col("conv_id") - F.pmod("conv_id", F.lit(every))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared).cast("int")
    heads = own.where(F.pmod("conv_id", F.lit(every)) == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, shared - 1).alias("head")
    )
    joined = own.withColumn("base", base).withColumn("h", h).join(heads, "base", "left")
    nothing = F.slice("turns", 1, 0)
    head = F.slice(F.coalesce("head", nothing), F.lit(1), F.col("h"))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return joined.select("conv_id", F.concat(head, rest).alias("turns"))


def child_key(key: bytes, hi: int, lo: int) -> bytes:
    return hashlib.blake2b(key + hi.to_bytes(8, "big", signed=True) + lo.to_bytes(8, "big", signed=True), digest_size=16).digest()


class Level:
    """Nodes of one depth in a shard, in the order of their sequences."""

    def __init__(self, first: np.ndarray, count: np.ndarray, parent: np.ndarray, length: np.ndarray):
        self.first = first  # a row of the node
        self.count = count
        self.parent = parent  # place in the level above
        self.length = length  # of the last text
        self.ends: dict[int, np.ndarray] = {}  # node: ids of the conversations that end there


def levels(lengths: np.ndarray, offsets: np.ndarray, flat: np.ndarray, convs: np.ndarray, band: int = BAND):
    """Levels of the trie of ``flat[offsets[i]:offsets[i] + lengths[i]]`` (hi, lo, length), root first, and each
    level's smallest conversation by node."""
    n = len(lengths)
    root = Level(np.zeros(1, np.int64), np.array([n]), np.zeros(1, np.int64), np.zeros(1, np.int64))
    found, smallest = [root], [np.array([convs.min()])]
    rows, above = np.arange(n), np.zeros(n, np.int64)  # rows still going, and the node each is in
    done = np.flatnonzero(lengths == 0)
    if len(done):
        root.ends[0] = np.sort(convs[done])
    start = 0
    while True:
        going = lengths[rows] > start
        rows, above = rows[going], above[going]
        if not len(rows):
            return found, smallest
        # As wide as what lies behind, so that a matrix is little larger than the turns in it.
        width = int(min(band, max(start, FIRST_BAND), lengths[rows].max() - start))
        column = np.arange(width)
        own = lengths[rows] - start
        inside = column[None, :] < own[:, None]
        place = np.where(inside, offsets[rows][:, None] + start + column[None, :], 0)
        hi, lo = (np.where(inside, flat[k][place], 0) for k in (0, 1))
        keys = [x[:, j] for j in reversed(range(width)) for x in (lo, inside, hi)]
        order = np.lexsort([convs[rows], *keys, above])
        rows, above, inside, hi, lo, place = rows[order], above[order], inside[order], hi[order], lo[order], place[order]
        change = np.ones((len(rows), width), dtype=bool)
        change[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1]) | (inside[1:] != inside[:-1])
        change[1:, 0] |= above[1:] != above[:-1]
        change = np.logical_or.accumulate(change, axis=1)
        for j in range(width):
            here = np.flatnonzero(inside[:, j])
            if not len(here):
                break
            # Rows that ended before this column lie between nodes, never inside one.
            mark = change[here, j]
            at = np.flatnonzero(mark)
            node = np.cumsum(mark) - 1
            ones = np.ones(len(here), np.int64)
            level = Level(rows[here[at]], np.add.reduceat(ones, at), above[here[at]], flat[2][place[here[at], j]])
            smallest.append(np.minimum.reduceat(convs[rows[here]], at))
            last = lengths[rows[here]] == start + j + 1
            if last.any():
                ids, of = convs[rows[here[last]]], node[last]
                by = np.lexsort([ids, of])
                ids, of = ids[by], of[by]
                cuts = np.flatnonzero(np.diff(of)) + 1
                for part, k in zip(np.split(ids, cuts), of[np.r_[0, cuts]], strict=True):
                    level.ends[int(k)] = part
            found.append(level)
            above = above.copy()
            above[here] = node
        start += width


def _joined(ids: np.ndarray) -> str:
    return ",".join(map(str, ids.tolist()))


def shard_nodes(convs: np.ndarray, lengths: np.ndarray, flat: np.ndarray, range_turns: int, band: int = BAND) -> list[tuple]:
    """Nodes of a shard, whose rows are in the order they are dealt by, as tuples in the order of NODE."""
    offsets = np.r_[0, np.cumsum(lengths)[:-1]].astype(np.int64)
    found, smallest = levels(lengths, offsets, flat, convs, band)

    def head(row: int) -> tuple:
        at, n = offsets[row], min(int(lengths[row]), range_turns)
        return tuple(zip(flat[0][at : at + n].tolist(), flat[1][at : at + n].tolist(), strict=True))

    # Shards are ranges of (first turns, conversation): other shards may hold what starts like the first or last row.
    heads = [head(i) for i in (0, len(convs) - 1)] if len(convs) else []
    open_by_level: list[np.ndarray] = []
    for d, level in enumerate(found):
        shared = np.zeros(len(level.count), dtype=bool)
        for k, row in enumerate(level.first.tolist()):
            if d == 0:
                shared[k] = True
            elif open_by_level[d - 1][level.parent[k]]:
                own = head(row)
                shared[k] = any(own[: min(d, range_turns)] == h[: min(d, range_turns)] for h in heads)
        open_by_level.append(shared)
    # From the deepest level up: children, leaves and saved tokens of what lies inside this shard alone.
    children = [np.zeros(len(x.count), np.int64) for x in found]
    leaves = [np.zeros(len(x.count), np.int64) for x in found]
    saved = [np.zeros(len(x.count), np.int64) for x in found]
    for d in range(len(found) - 1, -1, -1):
        level, shared = found[d], open_by_level[d]
        closed = ~shared
        leaves[d][closed & (children[d] == 0)] = 1
        saved[d][closed] += (level.count[closed] - 1) * level.length[closed]
        if d:
            np.add.at(leaves[d - 1], level.parent[closed], leaves[d][closed])
            np.add.at(saved[d - 1], level.parent[closed], saved[d][closed])
            np.add.at(children[d - 1], level.parent[closed], 1)
    out, keys = [], [{0: ROOT}]
    empty = hashlib.sha256(b"").hexdigest()
    for d, level in enumerate(found):
        if d:
            keys.append({})
        for k in range(len(level.count)):
            parent = int(level.parent[k])
            shared = bool(open_by_level[d][k])
            below = bool(d) and bool(open_by_level[d - 1][parent])
            if shared and d:
                at = offsets[level.first[k]] + d - 1
                keys[d][k] = child_key(keys[d - 1][parent], int(flat[0][at]), int(flat[1][at]))
            ends = level.ends.get(k)
            values = (
                int(smallest[d][k]), None if below or not d else int(smallest[d - 1][parent]), d, int(level.count[k]),
                int(children[d][k]), int(leaves[d][k]), int(saved[d][k]), int(level.length[k]),
            )
            if not shared:
                sha = empty if ends is None else hashlib.sha256(_joined(ends).encode()).hexdigest()
                out.append((None, keys[d - 1][parent] if below else None, *values, sha, None, False))
                continue
            parts = [None] if ends is None else [ends[i : i + IDS] for i in range(0, len(ends), IDS)]
            for i, part in enumerate(parts):
                # One row more for each further piece of the list, with nothing to add to sums.
                own = values if not i else (int(part[0]), values[1], d, 0, 0, 0, 0, values[7])
                first = own[0] if part is None else int(part[0])
                out.append((keys[d][k], keys[d - 1][parent] if d else None, *own, str(first), None if part is None else _joined(part), True))
    return out


def _shards(range_turns: int, band: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        rows = pa.Table.from_batches(parts) if parts else None
        if rows is None or not rows.num_rows:
            return
        convs = rows.column("conv_id").to_numpy()
        lengths = np.concatenate([np.diff(c.offsets.to_numpy()) for c in rows.column("turns").chunks]).astype(np.int64)
        flat = [
            np.concatenate([c.flatten().field(k).to_numpy(zero_copy_only=False) for c in rows.column("turns").chunks])
            for k in ("hi", "lo", "length")
        ]
        nodes = shard_nodes(convs, lengths, flat, range_turns, band)
        for i in range(0, len(nodes), 10_000):
            columns = list(zip(*nodes[i : i + 10_000], strict=True))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, _types(), strict=True)], names=_names())

    return run


def _names() -> list[str]:
    return [c.split()[0] for c in NODE.split(", ")]


def _types() -> list[pa.DataType]:
    kinds = {"binary": pa.binary(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    return [kinds[c.split()[1]] for c in NODE.split(", ")]


def _list_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 per key of lists that come in order, piece by piece; only one digest is open at a time."""
    key, digest = None, None

    def row():
        return pa.record_batch([pa.array([key], pa.binary()), pa.array([digest.hexdigest()])], names=["key", "ends_sha256"])

    for batch in batches:
        for own, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if own == key:
                digest.update(b"," + ids.encode())
            else:
                if key is not None:
                    yield row()
                key, digest = own, hashlib.sha256(ids.encode())
    if key is not None:
        yield row()


def _subtree_sums(nodes: DataFrame) -> DataFrame:
    """(key, n_leaves, saved_tokens) over subtrees of rows (key, parent, depth, n_leaves, saved_tokens): after
    step i each node holds what lies less than 2**i below it, and knows its ancestor at that distance."""
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    held = nodes.select("key", F.col("parent").alias("up"), "n_leaves", "saved_tokens")
    step = 1
    while step <= deepest:
        sent = held.where("up IS NOT NULL").groupBy("up").agg(F.sum("n_leaves").alias("_n"), F.sum("saved_tokens").alias("_s"))
        upper = held.select(F.col("key").alias("up"), F.col("up").alias("_up"))
        sums = held.join(sent.withColumnRenamed("up", "key"), "key", "left").select(
            "key", "up", *[(F.col(c) + F.coalesce(x, F.lit(0))).alias(c) for c, x in (("n_leaves", "_n"), ("saved_tokens", "_s"))]
        )
        held = stored(sums.join(upper, "up", "left").select("key", F.col("_up").alias("up"), "n_leaves", "saved_tokens"), "trie-sums")
        step *= 2
    return held.drop("up")


def trie(convs: DataFrame, shard_turns: int = SHARD_TURNS, range_turns: int = RANGE_TURNS, band: int = BAND) -> DataFrame:
    """One row per node of conversations (conv_id, turns): conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    spark = convs.sparkSession
    ship(spark)
    convs = stored(convs, "trie-sequences")
    total = convs.agg(F.sum(F.greatest(F.size("turns"), F.lit(1)))).first()[0] or 0
    shards = max(1, -(-int(total) // shard_turns))
    first = F.transform(F.slice("turns", 1, range_turns), lambda t: F.struct(t["hi"], t["lo"]))
    dealt = convs.withColumn("_first", first).repartitionByRange(shards, "_first", "conv_id")
    ordered = dealt.sortWithinPartitions("_first", "conv_id").select("conv_id", "turns")
    nodes = stored(ordered.mapInArrow(_shards(range_turns, band), NODE), "trie-nodes")

    parts = nodes.where("open")
    grouped = stored(
        parts.groupBy("key").agg(
            F.min("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
            F.max("length").alias("length"),
            *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        ),
        "trie-open",
    )
    # Children that are shared themselves, one for each distinct node.
    below = grouped.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("_below"))
    whole = grouped.join(below, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("_below", F.lit(0)))
    own = stored(
        whole.withColumn("n_leaves", F.col("n_leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0)).withColumn(
            "saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("length")
        ).drop("_below", "length"),
        "trie-own",
    )
    lists = parts.where("ids IS NOT NULL").select("key", F.col("ends_sha256").cast("long").alias("first"), "ids")
    hashed = lists.repartition("key").sortWithinPartitions("key", "first").select("key", "ids").mapInArrow(
        _list_digests, "key binary, ends_sha256 string"
    )
    upper = own.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    shared = (
        own.drop("n_leaves", "saved_tokens")
        .join(_subtree_sums(own), "key")
        .join(upper, "parent", "left")
        .join(hashed, "key", "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", nothing))
    )
    # A shared node may have any number of children that lie in one shard each.
    under = nodes.where("NOT open AND parent IS NOT NULL").drop("parent_conv_id", "key")
    counts = under.groupBy("parent").agg(F.count("*").alias("n")).join(upper, "parent")
    placed = join_groups(under, stored(counts, "trie-parents"), ["parent"], ["conv_id", "depth"])
    inner = nodes.where("NOT open AND parent IS NULL")
    return _columns(inner).unionByName(_columns(placed)).unionByName(_columns(shared))


def _columns(nodes: DataFrame) -> DataFrame:
    names: list[str | Column] = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    return nodes.select(*[F.col(c).cast("long").alias(c) for c in names], "ends_sha256")


def prefix_trie(turns: DataFrame, **sizes: int) -> DataFrame:
    """The trie of rebuilt conversations of rows (conv_id, turn, role, text)."""
    return trie(rebuilt(stored(sequences(turns), "trie-turns")), **sizes)
