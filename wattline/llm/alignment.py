"""Alignment of two tokenizers over a corpus.

Both tokenizers encode each text; byte offsets where tokens of both end cut the text into groups, and tokens
whose byte ranges overlap are linked. How often a pair of ids is linked is counted over the whole corpus:

* Documents are dealt to blocks of bounded size. A first pass aligns them and keeps, with each block, the ids of
  its different words, its distinct pairs and their counts, and each document as the numbers of its words.
* The distinct pairs of all blocks are dealt to shards, and each shard gets a minimal perfect hash: levels of
  bit arrays, in which a key that is alone at its place has it, and the others go on to the next level. Blocks'
  counts become dense vectors indexed by the hash and are summed as a tree, first by node, then by shard.
* The second pass aligns the documents again and looks up their pairs' counts. Lookups are joined by
  (shard, node) and come back by block, so no task needs the whole table and nothing of it is broadcast. A key
  is compared with the one stored at its place: a pair that the hash doesn't know is an error, never a wrong count.

Where both tokenizers certainly start a token, before a space behind another character than white space,
texts are cut into words, which are encoded once and remembered. Tokens of both sides end where a word ends, so
links and groups of a text are those of its words: a block aligns each of its different words once. Texts that are null or empty, or that a
tokenizer doesn't give back byte by byte (the second takes U+2581 for a space), have no tokens: zeros and an
empty string. Each row is answered on its own, so repeated rows and rows without an id are, too. Only
``doc_id`` and ``text`` are read; other columns may have any name.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.llm import pieces, token_counts
from wattline.llm.common import Memo, ship, stored, text_of

#: Characters of a block, about: what one task of the second pass holds.
BLOCK = 1 << 23
#: Pairs of a shard, about, counted once for each block they occur in.
SHARD = 1 << 20
#: Blocks whose counts are summed in one node of the tree.
FAN = 64
#: Words whose ids a worker remembers in each of two generations, and how long such a word may be.
MEMO_WORDS, MEMO_LENGTH = 250_000, 64
#: Words that are encoded in a row, and tokens that are aligned at a time.
ROW, LINKS = 1_024, 1 << 20
#: Size of a level of the hash for each key still to be placed, and the number of levels.
LOAD, LEVELS = 2, 48
#: Words are cut before a space behind any other character than white space.
CUT, UNCUT = re.compile(r"(?<=\S) "), re.compile(r"\s ")


class Aligner:
    """Aligns texts with two tokenizer files."""

    def __init__(self, a_path: str, b_path: str):
        self.a = token_counts.load(a_path)
        self.a.encode_special_tokens = True
        self.b = pieces.load(b_path)
        with open(a_path, encoding="utf-8") as file:
            spec = json.load(file)
        symbols = token_counts.byte_of_symbol()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_raw = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            if all(c in symbols for c in token):
                self.a_raw[i] = bytes([symbols[c] for c in token])
        self.b_raw = self.b.raw
        self.a_size, self.b_size = (np.array([len(r) for r in raw], np.int64) for raw in (self.a_raw, self.b_raw))
        most = max(len(self.a_raw), len(self.b_raw))
        # How ids are written: a comma behind most, another sign behind the last of a side.
        self.written = {
            sign: np.array([f"{i}{sign}" for i in range(most)], dtype=object) for sign in ",|;"
        }
        split = spec["pre_tokenizer"] or {}
        plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        self.cuts = plain and not spec["normalizer"] and self.b.tabled
        self.memo = Memo(MEMO_WORDS)

    def words(self, text: str) -> list[str]:
        """A text that isn't empty as words behind one space each; the whole text where no cut is certain."""
        if not self.cuts:
            return [text]
        return CUT.split(text) if UNCUT.search(text) or text[0] == " " else text.split(" ")

    def learn(self, words: list[str]) -> dict[str, tuple]:
        """The ids of each word with the space before it, in bytes; nothing where bytes get lost."""
        found = {w: known for w in words if (known := self.memo.get(w)) is not None}
        new = [w for w in words if w not in found]
        # In a row, words that end in no white space are encoded as they are alone; the mark is the one thing lost.
        safe = [w for w in new if self.cuts and w and not w[-1].isspace() and pieces.MARK not in w]
        for i in range(0, len(safe), ROW):
            found |= self.row(safe[i : i + ROW])
        for w in new:
            if w not in found:
                # The library adds no space to an empty text.
                b = self.b.library.encode(w) if w or not self.b.tabled else self.b.encode_word(w)
                ids = [np.array(x, np.int32) for x in (self.a.encode(" " + w, add_special_tokens=False).ids, b)]
                found[w] = tuple(x.tobytes() for x in ids) if self.given_back(w, *ids) else ()
            if len(w) <= MEMO_LENGTH:
                self.memo.put(w, found[w])
        return found

    def row(self, words: list[str]) -> dict[str, tuple]:
        """Words encoded together, and their ids parted by the bytes of each."""
        text = " ".join(words)
        ends = np.cumsum([len(w.encode()) + 1 for w in words])
        sides = []
        encoded = self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, self.b.library.encode(text)
        for ids, size in zip(encoded, (self.a_size, self.b_size), strict=True):
            ids = np.array(ids, np.int32)
            at = np.cumsum(size[ids])
            cut = np.searchsorted(at, ends)
            if (at[cut] != ends).any():
                raise ValueError("a token reaches over the end of a word")
            raw, cut = ids.tobytes(), (4 * cut + 4).tolist()
            sides.append([raw[i:j] for i, j in zip([0, *cut], cut, strict=False)])
        return dict(zip(words, zip(*sides, strict=True), strict=True))

    def given_back(self, text: str, a: np.ndarray, b: np.ndarray) -> bool:
        return b"".join([self.a_raw[k] for k in a]) == (" " + text).encode() == b"".join([self.b_raw[k] for k in b])

    def align(self, text: str | None) -> "Aligned | None":
        words = Words(self)
        numbers = words.numbers(text) if text else None
        words.learn()
        return None if numbers is None or words.lose(numbers) else Aligned(self, *ReadWords(*words.write()).ids(numbers))


class Numbers(dict):
    """A number for each word, the next one for a word that has none."""

    def __init__(self):
        self.new = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self[word] = number = len(self)
        return number


class Words:
    """The different words of a block of texts, by number, with the ids of both tokenizers."""

    def __init__(self, aligner: Aligner):
        self.aligner, self.number, self.forms, self.lost = aligner, Numbers(), [], []

    def numbers(self, text: str) -> np.ndarray:
        """The words of a text, to be learned."""
        words = self.aligner.words(text)
        return np.fromiter(map(self.number.__getitem__, words), np.int32, len(words))

    def learn(self) -> None:
        """Encodes the words that came in since."""
        new, self.number.new = self.number.new, []
        found = self.aligner.learn(new)
        for w in new:
            if not found[w]:
                self.lost.append(len(self.forms))
            self.forms.append(found[w] or (b"", b""))

    def lose(self, numbers: np.ndarray) -> bool:
        """Whether a word's bytes get lost."""
        return bool(self.lost) and bool(np.isin(numbers, self.lost).any())

    def write(self) -> list[bytes]:
        """The ids of all words, and how many each has, for both tokenizers."""
        out = []
        for k in (0, 1):
            own = [f[k] for f in self.forms]
            out += [planes(np.frombuffer(b"".join(own), np.int32)), planes(np.array([len(x) // 4 for x in own], np.int32))]
        return out


def planes(numbers: np.ndarray) -> bytes:
    """32-bit numbers as their lower halves and then their upper ones, which are mostly alike and compress well."""
    return np.ascontiguousarray(numbers.astype(np.int32).view(np.uint16).reshape(-1, 2).T).tobytes()


def from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint16).reshape(2, -1).T).view(np.int32).ravel()


class ReadWords:
    """What ``Words.write`` has kept."""

    def __init__(self, a_ids: bytes, a_sizes: bytes, b_ids: bytes, b_sizes: bytes):
        self.sides = []
        for ids, sizes in ((a_ids, a_sizes), (b_ids, b_sizes)):
            sizes = from_planes(sizes).astype(np.int64)
            self.sides.append((from_planes(ids), sizes, np.cumsum(sizes) - sizes))

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        out = []
        for ids, sizes, starts in self.sides:
            own = sizes[numbers]
            before = np.cumsum(own) - own
            out.append(ids[np.repeat(starts[numbers] - before, own) + np.arange(own.sum())])
        return tuple(out)

    def aligned(self, aligner: Aligner, numbers: np.ndarray) -> "Iterator[tuple[np.ndarray, Aligned, np.ndarray]]":
        """Some of the words in a row, their alignment, and where each ends, until it was all of them."""
        tokens = np.cumsum(sum(sizes[numbers] for _, sizes, _ in self.sides))
        cuts = np.searchsorted(tokens, np.arange(LINKS, tokens[-1], LINKS)) if len(numbers) else []
        for i, j in pairwise(np.unique(np.r_[0, cuts, len(numbers)].astype(np.int64)).tolist()):
            text = Aligned(aligner, *self.ids(numbers[i:j]))
            yield numbers[i:j], text, text.a_ends[np.cumsum(self.sides[0][1][numbers[i:j]]) - 1]


class Aligned:
    """A text's tokens on both sides and where they end."""

    def __init__(self, aligner: Aligner, a: np.ndarray, b: np.ndarray):
        self.aligner, self.a, self.b = aligner, a, b
        self.a_ends, self.b_ends = np.cumsum(aligner.a_size[a]), np.cumsum(aligner.b_size[b])
        both = np.sort(np.concatenate([self.a_ends, self.b_ends]), kind="stable")
        twice = both[1:] == both[:-1]
        #: Ends of tokens of either side, and of both: each link overlaps just up to one of the former.
        self.ends, self.common = both[np.r_[True, ~twice]], both[1:][twice]

    def links(self) -> np.ndarray:
        """The pair of ids of each link."""
        a = self.a[np.searchsorted(self.a_ends, self.ends)].astype(np.int64)
        return a << 32 | self.b[np.searchsorted(self.b_ends, self.ends)]

    def written(self) -> list[str]:
        """The tokens in writing, both sides' of a group after each other, with the signs behind them."""
        written, parts, order = self.aligner.written, [], []
        for side, (ids, ends, sign) in enumerate(((self.a, self.a_ends, "|"), (self.b, self.b_ends, ";"))):
            group = np.searchsorted(self.common, ends)
            parts.append(np.where(self.common[group] == ends, written[sign][ids], written[","][ids]))
            order.append(2 * group + side)
        place = np.argsort(np.concatenate(order), kind="stable")
        return np.concatenate(parts)[place].tolist()

    def groups(self) -> str:
        """The groups in writing."""
        return "".join(self.written())[:-1]


@lru_cache(2)
def load(a_path: str, b_path: str) -> Aligner:
    """One pair of tokenizers for each worker, kept from task to task."""
    return Aligner(a_path, b_path)


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """Hashes of 64-bit keys (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """A minimal perfect hash: a place from 0 to n - 1 for each of n distinct keys."""

    def __init__(self, sizes: list[int], bits: np.ndarray, rest: np.ndarray):
        self.sizes, self.bits, self.rest = sizes, bits, rest
        self.rank = np.cumsum(bits, dtype=np.int64)

    @staticmethod
    def build(keys: np.ndarray) -> "PerfectHash":
        sizes, levels, rest = [], [], np.asarray(keys, dtype=np.int64)
        while len(rest) and len(sizes) < LEVELS:
            size = max(64, LOAD * len(rest))
            at = (mixed(rest, len(sizes) + 1) % np.uint64(size)).astype(np.int64)
            held = np.bincount(at, minlength=size)
            sizes.append(size)
            levels.append(held == 1)
            rest = rest[held[at] > 1]
        # Keys that met at every level, if any, follow in their own order.
        return PerfectHash(sizes, np.concatenate([np.zeros(0, bool), *levels]), np.sort(rest))

    def place(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key; anything, or -1, for keys that the hash wasn't built of."""
        found, going, start = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = (mixed(keys[going], level + 1) % np.uint64(size)).astype(np.int64) + start
            hit = self.bits[at]
            found[going[hit]] = self.rank[at[hit]] - 1
            going, start = going[~hit], start + size
        if len(self.rest):
            at = np.searchsorted(self.rest, keys[going])
            known = self.rest[np.minimum(at, len(self.rest) - 1)] == keys[going]
            found[going[known]] = (self.rank[-1] if len(self.rank) else 0) + at[known]
        return found

    def write(self) -> bytes:
        head = np.array([len(self.sizes), len(self.rest), *self.sizes], np.int64).tobytes()
        return head + self.rest.tobytes() + np.packbits(self.bits).tobytes()

    @staticmethod
    def read(raw: bytes) -> "PerfectHash":
        levels, kept = np.frombuffer(raw, np.int64, 2).tolist()
        sizes = np.frombuffer(raw, np.int64, levels, 16).tolist()
        rest = np.frombuffer(raw, np.int64, kept, 16 + 8 * levels)
        packed = np.frombuffer(raw, np.uint8, offset=16 + 8 * (levels + kept))
        return PerfectHash(sizes, np.unpackbits(packed, count=sum(sizes)).astype(bool), rest)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of counts of each."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[at], np.add.reduceat(counts, at)


def longs(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.int64)


def _blocks(a_path: str, b_path: str, block: int, id_type: pa.DataType):
    """First pass: documents with their block as numbers of words, and one row for each block with the ids of its
    words, its distinct pairs and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number = load(a_path, b_path), TaskContext.get().partitionId() << 32
        words, seen, size = Words(aligner), [], 0

        def whole() -> pa.RecordBatch:
            raw, found = words.write(), [(np.zeros(0, np.int64),) * 2]
            times = np.bincount(np.concatenate([np.zeros(0, np.int32), *seen]), minlength=len(words.forms))
            for part, text, ends in ReadWords(*raw).aligned(aligner, np.flatnonzero(times)):
                links = np.diff(np.searchsorted(text.ends, ends, "right"), prepend=0)
                found.append(summed(text.links(), np.repeat(times[part], links)))
            raw += [x.tobytes() for x in summed(*(np.concatenate(x) for x in zip(*found, strict=True)))]
            columns = [pa.array([number], pa.int64()), pa.nulls(1, id_type), *(pa.array([x], pa.binary()) for x in (None, *raw))]
            return pa.record_batch(columns, names=NAMES)

        for batch in batches:
            start, rows = 0, []
            for i, text in enumerate(batch.column("text")):
                text = text.as_py()
                rows.append(words.numbers(text) if text else None)
                size += len(text)
                if size >= block or i == batch.num_rows - 1:
                    words.learn()
                    rows = [None if own is None or words.lose(own) else own for own in rows]
                    seen += [own for own in rows if own is not None]
                    numbers, nothing = pa.array([number] * len(rows), pa.int64()), pa.nulls(len(rows), pa.binary())
                    written = pa.array([None if own is None else planes(own) for own in rows], pa.binary())
                    yield pa.record_batch([numbers, batch.column("doc_id").slice(start, len(rows)), written, *[nothing] * 6], names=NAMES)
                    start, rows = i + 1, []
                if size >= block:
                    yield whole()
                    words, seen, size, number = Words(aligner), [], 0, number + 1
        if size:
            yield whole()

    return run


WORDS = ["a_ids", "a_sizes", "b_ids", "b_sizes"]
NAMES = ["block", "doc_id", "words", *WORDS, "keys", "counts"]


def _split(shards: int, nodes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, keys, counts in zip(*(batch.column(c).to_pylist() for c in ("block", "keys", "counts")), strict=True):
                keys, counts = longs(keys), longs(counts)
                shard = (mixed(keys, 0) % np.uint64(shards)).astype(np.int64)
                node = int(mixed(np.array([block]), 0)[0] % np.uint64(nodes))
                order = np.argsort(shard, kind="stable")
                bounds = np.searchsorted(shard[order], np.arange(shards + 1))
                own = [(s, order[bounds[s] : bounds[s + 1]]) for s in range(shards) if bounds[s] < bounds[s + 1]]
                for i in range(0, len(own), 256):
                    part = own[i : i + 256]
                    columns = [
                        pa.array([s for s, _ in part], pa.int64()),
                        pa.array([node] * len(part), pa.int64()),
                        pa.array([block] * len(part), pa.int64()),
                        pa.array([keys[at].tobytes() for _, at in part], pa.binary()),
                        pa.array([counts[at].tobytes() for _, at in part], pa.binary()),
                    ]
                    yield pa.record_batch(columns, names=["shard", "node", "block", "keys", "counts"])

    return run


def _union(rows: pa.Table) -> pa.Table:
    keys = np.unique(np.concatenate([longs(k) for k in rows.column("keys").to_pylist()]))
    return pa.table({"shard": rows.column("shard")[:1], "keys": pa.array([keys.tobytes()], pa.binary())})


def _hash(rows: pa.Table) -> pa.Table:
    keys = np.unique(np.concatenate([longs(k) for k in rows.column("keys").to_pylist()]))
    hashed = PerfectHash.build(keys)
    placed = np.empty_like(keys)
    placed[hashed.place(keys)] = keys
    return pa.table(
        {
            "shard": rows.column("shard")[:1],
            "keys": pa.array([placed.tobytes()], pa.binary()),
            "hash": pa.array([hashed.write()], pa.binary()),
        }
    )


def _places(table: pa.Table):
    """How to look up keys in a shard's stored row, verified."""
    hashed, held = PerfectHash.read(table.column("hash")[0].as_py()), longs(table.column("keys")[0].as_py())

    def find(keys: np.ndarray) -> np.ndarray:
        at = hashed.place(keys)
        if len(keys) and (at.min() < 0 or (held[at] != keys).any()):
            raise ValueError("a pair is not among those that were counted")
        return at

    return find, len(held)


def _dense(rows: pa.Table, shard: pa.Table) -> pa.Table:
    """Counts of a node's blocks as one dense vector."""
    empty = pa.table({"shard": pa.array([], pa.int64()), "counts": pa.array([], pa.binary())})
    if not rows.num_rows:
        return empty
    find, n = _places(shard)
    vector = np.zeros(n, np.int64)
    for keys, counts in zip(rows.column("keys").to_pylist(), rows.column("counts").to_pylist(), strict=True):
        vector[find(longs(keys))] += longs(counts)
    return pa.table({"shard": rows.column("shard")[:1], "counts": pa.array([vector.tobytes()], pa.binary())})


def _total(vectors: pa.Table, shard: pa.Table) -> pa.Table:
    """Counts of a shard, and the highest of each second id in it."""
    total = sum(longs(v) for v in vectors.column("counts").to_pylist())
    second = longs(shard.column("keys")[0].as_py()) & 0xFFFFFFFF
    order = np.argsort(second, kind="stable")
    at = np.flatnonzero(np.r_[True, np.diff(second[order]) != 0])
    return pa.table(
        {
            "shard": vectors.column("shard")[:1],
            "keys": shard.column("keys"),
            "hash": shard.column("hash"),
            "counts": pa.array([total.tobytes()], pa.binary()),
            "b_ids": pa.array([second[order][at]], pa.list_(pa.int64())),
            "highest": pa.array([np.maximum.reduceat(total[order], at)], pa.list_(pa.int64())),
        }
    )


def _look_up(highest: dict[int, int]):
    """``highest`` has an entry for each id of the second vocabulary at most."""

    def run(rows: pa.Table, shard: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.table({"block": pa.array([], pa.int64()), **{c: pa.array([], pa.binary()) for c in ("keys", "counts", "best")}})
        find, _ = _places(shard)
        total = longs(shard.column("counts")[0].as_py())
        top = np.zeros(max(highest) + 1, np.int64)
        top[list(highest)] = list(highest.values())
        counts, best = [], []
        for raw in rows.column("keys").to_pylist():
            keys = longs(raw)
            own = total[find(keys)]
            counts.append(own.tobytes())
            best.append((own == top[keys & 0xFFFFFFFF]).tobytes())
        return pa.table(
            {
                "block": rows.column("block"), "keys": rows.column("keys"),
                "counts": pa.array(counts, pa.binary()), "best": pa.array(best, pa.binary()),
            }
        )

    return run


def _finish(a_path: str, b_path: str, full: bool):
    """Second pass: the documents of a block, aligned again, with the counts of their pairs."""

    def run(block: pa.Table, looked_up: pa.Table) -> pa.Table:
        aligner = load(a_path, b_path)
        order, counts, best = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        if looked_up.num_rows:
            order, counts, best = (
                np.concatenate([np.frombuffer(x, kind) for x in looked_up.column(c).to_pylist()])
                for c, kind in (("keys", np.int64), ("counts", np.int64), ("best", bool))
            )
            by = np.argsort(order, kind="stable")
            order, counts, best = order[by], counts[by], best[by]
        is_words = np.array([x.is_valid for x in block.column("a_ids")], dtype=bool)
        held = block.filter(pa.array(is_words))
        words = ReadWords(*(held.column(c)[0].as_py() for c in WORDS)) if held.num_rows else None
        docs = block.filter(pa.array(~is_words))
        numbers = [None if own is None else from_planes(own) for own in docs.column("words").to_pylist()]
        known = [own for own in numbers if own is not None]
        # Of each word that texts hold, what adds up to a text's counts, and its groups in writing.
        used = np.flatnonzero(np.bincount(np.concatenate(known))) if known else np.zeros(0, np.int64)
        place, of_word, forms = np.zeros(used.max(initial=-1) + 1, np.int64), np.zeros((len(used), 6), np.int64), []
        place[used] = np.arange(len(used))
        for part, text, ends in words.aligned(aligner, used) if known else ():
            links = text.links()
            at = np.minimum(np.searchsorted(order, links), len(order) - 1)
            if (order[at] != links).any():
                raise ValueError("a pair of a document was not counted")
            to = np.searchsorted(text.ends, ends, "right")
            of = np.r_[0, to[:-1]]
            own = of_word[len(forms) : len(forms) + len(part)].T
            own[0], own[1] = (sizes[part] for _, sizes, _ in words.sides)
            own[2] = np.diff(np.searchsorted(text.common, ends, "right"), prepend=0)
            own[3], own[4], own[5] = to - of, np.add.reduceat(best[at].astype(np.int64), of), np.add.reduceat(counts[at], of)
            signs, last = text.written(), np.cumsum(own[0] + own[1]).tolist()
            forms += ["".join(signs[i:j]) for i, j in pairwise([0, *last])]
        rows, written = np.zeros((6, docs.num_rows), np.int64), []
        for k, own in enumerate(numbers):
            if own is None:
                written.append("")
                continue
            own = place[own]
            rows[:, k] = of_word[own].sum(axis=0)
            groups = "".join([forms[n] for n in own.tolist()])[:-1]
            written.append(groups if full else hashlib.sha256(groups.encode()).hexdigest())
        columns = dict(zip(COUNTS, (pa.array(r) for r in rows), strict=True))
        return pa.table({"doc_id": docs.column("doc_id"), **columns, "groups" if full else "groups_sha256": pa.array(written, pa.string())})

    return run


COUNTS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def aligned(
    docs: DataFrame, a_path: str, b_path: str, full: bool = False, block: int = BLOCK, shard: int = SHARD, fan: int = FAN
) -> tuple[DataFrame, DataFrame]:
    """Documents, and counted pairs (a_id, b_id, n).

    A document's row has doc_id, n_a and n_b (tokens), n_groups, n_links, n_best (links whose pair is the most
    frequent one of its second id), count_sum (over its links), and groups_sha256 or, if ``full``, the groups in
    writing: ids of both sides, as in "1,2|7;3|8,9"."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select("doc_id", text_of(docs).alias("text"))
    id_field = rows.schema["doc_id"]
    id_arrow = _arrow_type(id_field)
    kept = T.StructType(
        [T.StructField("block", T.LongType()), id_field] + [T.StructField(c, T.BinaryType()) for c in NAMES[2:]]
    )
    first = stored(rows.mapInArrow(_blocks(a_path, b_path, block, id_arrow), kept), "align-blocks")
    lists = first.where("keys IS NOT NULL").select("block", "keys", "counts")
    blocks, entries = lists.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("keys")), F.lit(0))).first()
    shards, nodes = max(1, -(-int(entries) // (8 * shard))), max(1, -(-blocks // fan))
    parts = lists.mapInArrow(_split(shards, nodes), "shard long, node long, block long, keys binary, counts binary")

    united = parts.select("shard", "node", "keys").groupBy("shard", "node").applyInArrow(_union, "shard long, keys binary")
    hashes = stored(united.groupBy("shard").applyInArrow(_hash, "shard long, keys binary, hash binary"), "align-hashes")

    def by_node(table: DataFrame):
        """A shard's row for each node."""
        return table.withColumn("node", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(nodes - 1).cast("long")))).groupBy("shard", "node")

    dense = parts.groupBy("shard", "node").cogroup(by_node(hashes)).applyInArrow(_dense, "shard long, counts binary")
    totals = stored(
        dense.groupBy("shard").cogroup(hashes.groupBy("shard")).applyInArrow(
            _total, "shard long, keys binary, hash binary, counts binary, b_ids array<long>, highest array<long>"
        ),
        "align-counts",
    )
    tops = totals.select(F.explode(F.arrays_zip("b_ids", "highest")).alias("x")).groupBy("x.b_ids").agg(F.max("x.highest"))
    highest = dict(map(tuple, tops.collect()))  # a row for each id of the second vocabulary at most
    table = totals.select("shard", "keys", "hash", "counts")
    looked_up = parts.groupBy("shard", "node").cogroup(by_node(table)).applyInArrow(
        _look_up(highest), "block long, keys binary, counts binary, best binary"
    )
    shown = T.StructField("groups" if full else "groups_sha256", T.StringType())
    schema = T.StructType([id_field, *[T.StructField(c, T.LongType()) for c in COUNTS], shown])
    documents = first.select(*NAMES[:-2]).groupBy("block").cogroup(looked_up.groupBy("block")).applyInArrow(_finish(a_path, b_path, full), schema)
    return documents, table.select("keys", "counts").mapInArrow(_pairs, "a_id long, b_id long, n long")


def _arrow_type(field: T.StructField) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(field.dataType)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for keys, counts in zip(batch.column("keys").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            keys, counts = longs(keys), longs(counts)
            for i in range(0, len(keys), 100_000):
                part = keys[i : i + 100_000]
                yield pa.record_batch([part >> 32, part & 0xFFFFFFFF, counts[i : i + 100_000]], names=["a_id", "b_id", "n"])
