"""BPE encoding and decoding with forced-boundary splitting.

Two neighbouring bytes that occur in that order inside no token of the vocabulary are never merged:
a cut between them is certain. Pairs with ASCII white space are of that kind when no token holds
white space, so a text is first cut there; a fragment met for the first time is cut again at such
pairs of ASCII bytes of different classes (letter, digit, sign), where the vocabulary's word ends
fall as well. Fragments are encoded on their own, remembered, and concatenated.

A vocabulary without these properties (tokens that hold white space, say) is used on whole texts.
Null texts count as empty: no tokens. Each row is answered on its own, so repeated rows and rows
without an id are, too. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from wattline.llm.common import ship, text_of
from wattline.llm.token_counts import BATCH, MEMO_LENGTH, byte_of_symbol, load

#: Fragments that a worker remembers at once.
MEMO_WORDS = 300_000
SPACES = b" \t\n\r\x0b\x0c"
#: Where the class of ASCII bytes may change: a letter run, a digit, a sign run, anything else.
RUNS = re.compile(rb"[A-Za-z]+|[0-9]|[!-&(-/:-@\[-`{-~]+|[^!-~]+|'")


def pair_table(tokens: list[bytes]) -> np.ndarray:
    """[a, b]: whether byte b follows byte a inside any token."""
    table = np.zeros((256, 256), dtype=bool)
    for token in tokens:
        own = np.frombuffer(token, dtype=np.uint8)
        table[own[:-1], own[1:]] = True
    return table


def byte_classes() -> np.ndarray:
    """0 letter, 1 digit, 2 sign, 3 other: an apostrophe may start a contraction, bytes above 0x7F may be anything."""
    kinds = np.full(256, 3, dtype=np.uint8)
    for b in range(0x21, 0x7F):
        c = chr(b)
        kinds[b] = 0 if c.isalpha() else 1 if c.isdigit() else 3 if c == "'" else 2
    return kinds


class Codec:
    """Encodes and decodes texts with a tokenizer file."""

    def __init__(self, path: str):
        self.tokenizer = load(path)
        with open(path, encoding="utf-8") as file:
            self.spec = json.load(file)
        self.memo: dict[bytes, tuple[int, str, str]] = {}
        self.kinds = byte_classes()

    @cached_property
    def pairs(self) -> np.ndarray:
        symbols, suffix = byte_of_symbol(), self.spec["model"].get("end_of_word_suffix") or ""
        tokens = [t.removesuffix(suffix) if suffix else t for t in self.spec["model"]["vocab"]]
        plain = [bytes(symbols[c] for c in t) for t in tokens if all(c in symbols for c in t)]
        return pair_table(plain + [t["content"].encode() for t in self.spec["added_tokens"]])

    @cached_property
    def splits(self) -> bool:
        """Whether texts may be cut at white space and fragments joined again by one space when decoded."""
        steps = (self.spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        lowers = {"type": "Lowercase"} in (self.spec["normalizer"] or {}).get("normalizers", [])
        drops = lowers and any(s["type"] == "Split" and s["behavior"] == "Removed" and s["invert"] for s in steps)
        space = np.frombuffer(SPACES, dtype=np.uint8)
        spaced = self.pairs[space].any() or self.pairs[:, space].any()
        strips = any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in self.spec["added_tokens"])
        return drops and not spaced and not strips and self.spec["decoder"] is None

    def fragments(self, word: bytes) -> list[bytes]:
        """``word`` cut at every forced boundary between runs of different ASCII classes."""
        if word.isalpha():
            return [word]
        cut, start = [], 0
        for run in RUNS.finditer(word):
            at = run.start()
            if at > start:
                a, b = word[at - 1 : at + 1].lower()
                if self.kinds[a] < 3 and self.kinds[b] < 3 and not self.pairs[a, b]:
                    cut.append(word[start:at])
                    start = at
        return [*cut, word[start:]]

    def encode_fragments(self, parts: list[bytes]) -> dict[bytes, tuple[int, str, str]]:
        found, rest = {}, []
        for p in parts:
            if not p.isalpha():
                rest.append(p)
                continue
            # ASCII letters: normalising only lower-cases them, and they are one word.
            tokens = self.tokenizer.model.tokenize(p.lower().decode())
            found[p] = (len(tokens), " ".join([str(t.id) for t in tokens]), " ".join([t.value for t in tokens]))
        for i in range(0, len(rest), BATCH):
            part = rest[i : i + BATCH]
            texts = [p.decode() for p in part]
            for p, e in zip(part, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                ids = e.ids
                found[p] = (len(ids), " ".join(map(str, ids)), self.tokenizer.decode(ids, skip_special_tokens=False))
        return found

    def encode_new(self, words: list[bytes]) -> dict[bytes, tuple[int, str, str]]:
        cut = {w: self.fragments(w) for w in words}
        known = {p: self.memo[p] for parts in cut.values() for p in parts if p in self.memo}
        known |= self.encode_fragments(list({p for parts in cut.values() for p in parts} - known.keys()))
        found = {}
        for w, parts in cut.items():
            if len(parts) > 1:
                own = [known[p] for p in parts if known[p][0]]
                found[w] = (sum(x[0] for x in own), " ".join([x[1] for x in own]), " ".join([x[2] for x in own]))
            else:
                found[w] = known[w]
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        self.memo.update((p, x) for p, x in (known | found).items() if len(p) <= MEMO_LENGTH)
        return found

    def convert(self, text: str) -> tuple[int, str, str]:
        """Number of ids, the ids joined by spaces, the decoded text."""
        if not self.splits:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return len(ids), " ".join(map(str, ids)), self.tokenizer.decode(ids, skip_special_tokens=False)
        words = text.encode().split()
        parts = list(map(self.memo.get, words))
        if None in parts:
            new = self.encode_new(list({w for w, p in zip(words, parts, strict=True) if p is None}))
            parts = [new[w] if p is None else p for w, p in zip(words, parts, strict=True)]
        counts, ids, decoded = zip(*parts, strict=True) if parts else ((), (), ())
        if 0 in counts:  # words of other white space only
            ids, decoded = zip(*[(i, d) for n, i, d in parts if n], strict=True) if any(counts) else ((), ())
        return sum(counts), " ".join(ids), " ".join(decoded)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids (array of int), decoded: the full output of encoding and decoding."""
    ship(docs.sparkSession)
    rows = docs.select("doc_id", text_of(docs).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for batch in batches:
            for i in range(0, batch.num_rows, BATCH):
                part = batch.slice(i, BATCH)
                out = [codec.convert(t.as_py()) for t in part.column("text")]
                yield pa.record_batch(
                    [
                        part.column("doc_id"),
                        pa.array([x[0] for x in out], pa.int64()),
                        pa.array([list(map(int, x[1].split())) for x in out], pa.list_(pa.int32())),
                        pa.array([x[2] for x in out]),
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
        codec = Codec(path)
        for batch in batches:
            counts, ids, decoded = [], [], []
            for text in batch.column("text"):
                n, i, d = codec.convert(text.as_py())
                counts.append(n)
                ids.append(hashlib.sha256(i.encode()).hexdigest())
                decoded.append(hashlib.sha256(d.encode()).hexdigest())
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    text = [T.StructField(c, T.StringType()) for c in ("ids_sha256", "decoded_sha256")]
    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], T.StructField("n_tokens", T.LongType()), *text]))
