"""Conversation prefix trie against plain dictionaries."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from wattline.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt_by_hand(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            key = hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest()[:16]
            halves = tuple(int.from_bytes(key[i : i + 8], "big", signed=True) for i in (0, 8))
            own[c].append((turn is not None, turn or 0, halves, (role or "", text or "")))
    own = {c: [t[3] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
    return out


def nodes_by_hand(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        ends[turns].append(c)
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(set)
    for p in members:
        if p:
            children[p[:-1]].add(p)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, own in members.items():
        worth = (len(own) - 1) * (len(p[-1][1]) if p else 0)
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += worth
    return sorted(
        (
            min(own), len(p), min(members[p[:-1]]) if p else None, len(own), len(children.get(p, ())), leaves[p], saved[p],
            hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest(),
        )
        for p, own in members.items()
    )


def rows_of(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert df.columns == names
    return sorted(tuple(r) for r in df.collect())


def random_rows(seed, n=230, texts=3, longest=9):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(3 * n), n):
        for turn in range(rng.randint(1, longest)):
            rows.append((c, turn, rng.choice(["user", "user", None]), rng.choice(["", None, "a", "bé", "🙂x"][: texts + 1])))
    return rows


@pytest.mark.parametrize("sizes", [{}, {"shard_turns": 40}, {"shard_turns": 40, "range_turns": 2}, {"shard_turns": 60, "band": 2}])
def test_equals_dictionaries(spark, sizes):
    rows = random_rows(len(sizes))
    found = rows_of(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), **sizes))
    assert found == nodes_by_hand(rebuilt_by_hand(rows))


def test_hot_conversation_ties_nulls_and_repeats(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(300) for t in range(7)]  # a third and more alike
    rows += [(1000, None, "user", "first"), (1000, 3, "b", "x"), (1000, 3, "a", "x"), (1000, 3, "a", "x")]
    rows += [(None, 0, "user", "lost"), (1001, 0, None, None), (1002, 0, "", "")]
    found = prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), shard_turns=100, range_turns=3)
    assert rows_of(found) == nodes_by_hand(rebuilt_by_hand(rows))


def test_one_long_conversation_among_short_ones(spark):
    rows = [(c, t, "user", f"{c % 3} {t}") for c in range(40) for t in range(4)]
    rows += [(c, t, "user", f"long {t if t < 290 else (c, t)}") for c in (100, 107, 300) for t in range(300)]
    found = prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), shard_turns=200)
    assert rows_of(found) == nodes_by_hand(rebuilt_by_hand(rows))


def test_turnless_conversations_are_members_of_the_root(spark):
    rows = [(c, 0, "user", "x") for c in range(201, 260)]  # no base conversation: most lose their only turn
    convs = rebuilt_by_hand(rows)
    assert () in convs.values()
    assert rows_of(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == nodes_by_hand(convs)


def test_empty_table_and_extra_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert rows_of(prefix_trie.prefix_trie(empty)) == []
    rows = random_rows(7, n=20)
    extra = spark.createDataFrame([(*r, 1, "k", True) for r in rows], SCHEMA + ", turns int, key string, open boolean")
    assert rows_of(prefix_trie.prefix_trie(extra)) == nodes_by_hand(rebuilt_by_hand(rows))


def test_levels_of_bands_agree():
    rng = np.random.default_rng(5)
    lengths = rng.integers(0, 40, 200)
    total = int(lengths.sum())
    flat = [rng.integers(0, 2, total), rng.integers(0, 2, total), rng.integers(0, 9, total)]
    # The length of a text follows from the turn.
    flat[2] = flat[0] * 2 + flat[1]
    convs = rng.permutation(200)
    wide = prefix_trie.shard_nodes(convs, lengths, flat, 16)
    assert sorted(map(str, wide)) == sorted(map(str, prefix_trie.shard_nodes(convs, lengths, flat, 16, band=3)))


SMALL = "/root/testdata/sf0.001"


def test_query_on_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(queries.op13_prefix_trie(spark, SMALL)) == nodes_by_hand(rebuilt_by_hand(rows))
