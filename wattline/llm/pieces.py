"""SentencePiece encoding and decoding by a prefix table.

In a merge-type vocabulary every prefix of a text ends, when encoded, in one certain token. A table
holds that token for each prefix: an automaton over all pieces names the pieces that end at a place,
and the one that is compatible with the last token of the prefix before it is the prefix's own. Two
tokens are compatible if encoding their texts together gives these two again; that is decided by
undoing their merges, latest first, and looking for a merge across the border that would have come
earlier. The ids are read off backwards from the table's end.

A cut between two characters that no piece holds side by side is certain. Space marks are such a place, so texts
are encoded word by word, words in fragments, and both are remembered. Runs of space marks, whose pieces share one score below all
others, are merged from the left and stand on their own. A vocabulary in which a piece is made of later pieces, in
which pieces share a score, or whose normaliser changes texts is left to the library as a whole.

Null texts count as empty: only the begin and end ids. Each row is answered on its own, so repeated rows
and rows without an id are, too. Only ``doc_id`` and ``text`` are read; other columns may have any name.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from wattline.llm.common import Memo, ship, text_of

#: The space mark of pieces.
MARK = "▁"
#: Words, and fragments of words, that a worker remembers in each of two generations, and how long they may be.
MEMO_WORDS, MEMO_LENGTH = 200_000, 64
#: Pairs of tokens whose compatibility a worker remembers.
MEMO_PAIRS = 1_000_000
#: Stands in the table for a character that no piece holds.
UNKNOWN = -1
#: Words of a text behind one space each; more spaces before a word, or at the end, belong to the word.
WORDS = re.compile(r" ( *[^ ]+| *$)")
#: Runs of characters, between which a fragment may end.
RUNS = re.compile(f"[{MARK}A-Za-z]+|[^{MARK}A-Za-z]+")
BATCH = 64


def merged(symbols: list[str], ranks: dict[str, float]) -> list[str]:
    """Plain byte-pair merging: best rank first, leftmost among equals."""
    symbols = list(symbols)
    while len(symbols) > 1:
        found = [(ranks[s], i) for i in range(len(symbols) - 1) if (s := symbols[i] + symbols[i + 1]) in ranks]
        if not found:
            break
        at = min(found)[1]
        symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
    return symbols


class Pieces:
    """Encodes texts with a model file and decodes ids."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        lib, size = self.library, self.library.get_piece_size()
        self.texts = [lib.id_to_piece(i) for i in range(size)]
        self.bytes_of = {int(self.texts[i][3:-1], 16): i for i in range(size) if lib.is_byte(i)}
        special = {i for i in range(size) if lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i)}
        self.ids = {self.texts[i]: i for i in range(size) if i not in special}
        self.ranks = {t: -lib.get_score(i) for t, i in self.ids.items()}
        self.begin, self.end = lib.bos_id(), lib.eos_id()
        #: What a token stands for, in bytes; nothing for begin and end.
        self.raw = [t.replace(MARK, " ").encode() if i not in special else b"" for i, t in enumerate(self.texts)]
        for byte, i in self.bytes_of.items():
            self.raw[i] = bytes([byte])
        self._prepare()
        self.memo, self.known = Memo(MEMO_WORDS), Memo(MEMO_WORDS)

    def _prepare(self) -> None:
        """Ranks, the two parts each piece is merged from, the automaton, and whether the table applies."""
        rank, self.left, self.right, self.pair = {}, {}, {}, {}
        runs, odd = set(), False
        for text, i in self.ids.items():
            rank[i] = -1.0 if len(text) == 1 else self.ranks[text]
            if len(text) > 1 and not text.strip(MARK):
                runs.add(text)
        own = {t: r for t, r in self.ranks.items() if len(t) > 1 and t not in runs}
        odd = len(set(own.values())) < len(own) or any(MARK in t[1:] for t in own)
        # Runs of marks must come after every other merge.
        odd |= bool(runs) and bool(own) and min(self.ranks[r] for r in runs) <= max(own.values())
        self.automaton = ahocorasick.Automaton()
        for text, i in self.ids.items():
            if len(text) == 1:
                self.automaton.add_word(text, (i, 1))
            elif text not in runs:
                parts = self._parts(text, own)
                if parts is None:
                    continue  # no merge ever makes it
                a, b = (self.ids[p] for p in parts)
                odd |= max(rank[a], rank[b]) >= rank[i]
                self.left[i], self.right[i] = a, b
                self.automaton.add_word(text, (i, len(text)))
        if len(self.automaton):
            self.automaton.make_automaton()
        self.rank, self.own = rank, own
        #: Neighbouring characters of any piece: between others no merge ever happens.
        self.together = {t[i : i + 2] for t in self.ids for i in range(len(t) - 1)}
        self.runs, self.longest = {r: self.ranks[r] for r in runs}, max(map(len, runs), default=1)
        self.tabled = not odd and self._plain_library() and MARK in self.ids
        self.tabled = self.tabled and all(
            self._run(n) == self.library.encode(" " * (n - 1)) for n in range(2, 4 * self.longest)
        )

    def _plain_library(self) -> bool:
        """Whether the library takes texts as they are but for one space before them, and has an id for each byte."""
        every = "".join(map(chr, [*range(1, 0xD800), *range(0xE000, 0x10000)]))
        probes = [every, " a  b ", "e\u0301 \u1100\u1161", "\t\r\n x\x00"]
        same = all(self.library.normalize(t) == MARK + t.replace(" ", MARK) for t in probes)
        return same and self.library.encode("") == [] and len(self.bytes_of) == 256 and min(self.begin, self.end) >= 0

    def _parts(self, text: str, ranks: dict[str, float]) -> tuple[str, str] | None:
        """The two symbols whose merge makes the piece, or none if its characters end up otherwise."""
        below = {s: ranks[s] for i in range(len(text)) for j in range(i + 2, len(text) + 1) if (s := text[i:j]) in ranks}
        if merged(list(text), below) != [text]:
            return None
        del below[text]
        parts = merged(list(text), below)
        return (parts[0], parts[1]) if len(parts) == 2 and all(p in self.ids for p in parts) else None

    def compatible(self, a: int, b: int) -> bool:
        """Whether token ``a`` followed by ``b`` stays as it is."""
        return a == UNKNOWN or self._compatible(a, b)

    def _compatible(self, a: int, b: int) -> bool:
        rank, texts, own = self.rank, self.texts, self.own
        # While both tokens stand, any merge of the two happens; before a was made, one ranked below a's;
        # before b was made, one up to b's rank, as it lies to the left of b's.
        limit, strict = float("inf"), True
        while True:
            across = own.get(texts[a] + texts[b])
            if across is not None and (across < limit or not strict and across == limit):
                return False
            if a not in self.right and b not in self.left:
                return True
            if rank[a] > rank[b]:
                limit, strict, a = rank[a], True, self.right[a]
            else:
                limit, strict, b = rank[b], False, self.left[b]

    def table(self, text: str) -> list[int]:
        """For each prefix of a text without runs of marks, the last token of its encoding."""
        last, pair = [UNKNOWN] * (len(text) + 1), self.pair
        filled = 0
        if len(pair) > MEMO_PAIRS:
            pair.clear()
        for end, (token, length) in self.automaton.iter(text):
            if end >= filled:
                start = end + 1 - length
                before = last[start] if start else UNKNOWN
                if before != UNKNOWN:
                    key = before << 32 | token
                    known = pair.get(key)
                    if known is None:
                        known = pair[key] = self._compatible(before, token)
                    if not known:
                        continue
                last[end + 1] = token
                filled = end + 1
        return last

    def fragments(self, text: str) -> list[str]:
        """``text`` cut between runs of letters and others wherever no piece holds the two characters together."""
        found = []
        for run in RUNS.findall(text):
            if found and found[-1][-1] + run[0] in self.together:
                found[-1] += run
            else:
                found.append(run)
        return found

    def _word(self, text: str) -> list[int]:
        """Ids of a text without runs of marks."""
        found = []
        for part in self.fragments(text):
            ids = self.known.get(part)
            if ids is None:
                ids = self._read_off(part)
                if len(part) <= MEMO_LENGTH:
                    self.known.put(part, ids)
            found += ids
        return found

    def _read_off(self, text: str) -> list[int]:
        """Ids read backwards from a text's table."""
        last, texts, at, found = self.table(text), self.texts, len(text), []
        while at:
            token = last[at]
            if token == UNKNOWN:
                found += [self.bytes_of[b] for b in reversed(text[at - 1].encode())]
                at -= 1
            else:
                found.append(token)
                at -= len(texts[token])
        found.reverse()
        return found

    def _run(self, n: int) -> list[int]:
        """Ids of ``n`` marks in a row. All merges rank alike, so the leftmost token is done first."""
        found = []
        while n:
            first = merged([MARK] * min(n, 2 * self.longest), self.runs)[0]
            found.append(self.ids[first])
            n -= len(first)
        return found

    def encode_word(self, word: str) -> list[int]:
        """Ids of one space and ``word``, which may start with more spaces."""
        bare = word.lstrip(" ")
        spaces = len(word) - len(bare)
        own = self._word(MARK + bare) if bare else []
        if not bare or spaces and own[0] == self.ids[MARK]:
            return self._run(spaces + 1) + own[1:]
        return self._run(spaces) + own

    def remembered(self, word: str) -> list[int]:
        ids = self.memo.get(word)
        if ids is None:
            ids = self.encode_word(word)
            if len(word) <= MEMO_LENGTH:
                self.memo.put(word, ids)
        return ids

    def words(self, text: str) -> list[str]:
        """A text that isn't empty as words behind one space each."""
        text = text.replace(MARK, " ")
        if "  " in text or text[0] == " " or text[-1] == " ":
            return WORDS.findall(" " + text)
        return text.split(" ")

    def encode(self, text: str) -> list[int]:
        """Ids without begin and end."""
        if not self.tabled:
            return self.library.encode(text)
        return [i for w in self.words(text) for i in self.remembered(w)] if text else []

    def decode(self, ids: list[int]) -> str:
        """The text of ids: begin and end stand for nothing, the space before the first word goes."""
        if not self.tabled:
            return self.library.decode(ids)
        return self.bytes_to_text(b"".join([self.raw[i] for i in ids]))

    @staticmethod
    def bytes_to_text(raw: bytes) -> str:
        return raw.decode("utf-8", "replace").removeprefix(" ")


@lru_cache(2)
def load(path: str) -> Pieces:
    """One vocabulary for each worker, kept from task to task."""
    return Pieces(path)


@lru_cache(2)
def word_forms(path: str) -> "WordForms":
    return WordForms(load(path))


class WordForms:
    """Per word, what the digests of texts are put together from."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.packed = [np.array([i], dtype="<u4").tobytes() for i in range(len(pieces.texts))]
        self.memo = Memo(MEMO_WORDS)

    def form(self, word: str) -> tuple[int, bytes, bytes]:
        pieces = self.pieces
        ids = pieces.encode_word(word)
        return len(ids), b"".join([self.packed[i] for i in ids]), b"".join([pieces.raw[i] for i in ids])

    def convert(self, text: str) -> tuple[int, bytes, bytes]:
        """Number of ids, the ids as little-endian words, the decoded text in UTF-8; begin and end included."""
        pieces = self.pieces
        if not pieces.tabled:
            ids = [pieces.begin, *pieces.library.encode(text), pieces.end]
            return len(ids), np.array(ids, dtype="<u4").tobytes(), pieces.library.decode(ids).encode()
        head, tail = self.packed[pieces.begin], self.packed[pieces.end]
        if not text:
            return 2, head + tail, b""
        words = pieces.words(text)
        forms = list(map(self.memo.young.get, words))
        if None in forms:
            new = {}
            for w in {w for w, f in zip(words, forms, strict=True) if f is None}:
                new[w] = self.memo.get(w) or self.form(w)
                if len(w) <= MEMO_LENGTH:
                    self.memo.put(w, new[w])
            forms = [new[w] if f is None else f for w, f in zip(words, forms, strict=True)]
        counts, ids, raw = zip(*forms, strict=True)
        return sum(counts) + 2, head + b"".join(ids) + tail, b"".join(raw).removeprefix(b" ")


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids (array of int, begin and end included), decoded: the full output."""
    ship(docs.sparkSession)
    rows = docs.select("doc_id", text_of(docs).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(path)
        for batch in batches:
            for i in range(0, batch.num_rows, BATCH):
                part = batch.slice(i, BATCH)
                ids = [[pieces.begin, *pieces.encode(t.as_py()), pieces.end] for t in part.column("text")]
                yield pa.record_batch(
                    [
                        part.column("doc_id"),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array(ids, pa.list_(pa.int32())),
                        pa.array([pieces.decode(x) for x in ids], pa.string()),
                    ],
                    names=["doc_id", "n_tokens", "ids", "decoded"],
                )

    schema = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))]
    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], *schema, T.StructField("decoded", T.StringType())]))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256. Ids and decoded texts are
    hashed where they are made and do not leave the worker."""
    ship(docs.sparkSession)
    rows = docs.select("doc_id", text_of(docs).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forms = word_forms(path)
        for batch in batches:
            counts, ids, decoded = [], [], []
            for text in batch.column("text"):
                n, own, raw = forms.convert(text.as_py())
                counts.append(n)
                ids.append(hashlib.sha256(own).hexdigest())
                decoded.append(hashlib.sha256(raw).hexdigest())
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    text = [T.StructField(c, T.StringType()) for c in ("ids_sha256", "decoded_sha256")]
    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], T.StructField("n_tokens", T.LongType()), *text]))
