"""Token counts of whole texts; huge documents are encoded in overlapping chunks that are resynchronised.

A chunk's encoding is cut into pieces before byte pairs are merged, and where a piece starts depends
on the text behind that place only. So when two overlapping chunks both start a piece at one place,
and the place is far enough from the left chunk's end for that end to have had no influence, all
tokens of the right chunk from there on are those of the whole text: the chunks are spliced there.
Pairs of chunks without such a place are encoded again with longer chunks and wider overlaps, until
they agree or one chunk holds the document.

Null texts count as empty: no bytes, no tokens. Each row is answered on its own, so repeated rows and
rows without an id are, too. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from wattline.llm.common import Memo, keep, ship, stored, text_of

#: Characters of a chunk and of its overlap with the one before.
CHUNK, OVERLAP = 32_768, 1_024
#: Chunks of a task.
CHUNKS = 128
#: A left chunk's last characters may be encoded otherwise than in the whole text: a contraction or a
#: special token may be cut there. Longer than either.
MARGIN = 64
#: Words whose counts a worker remembers in each of two generations, and how long such a word may be.
MEMO_WORDS, MEMO_LENGTH = 450_000, 64
#: Texts that the library encodes in one call.
BATCH = 64
#: A space behind any other character than white space: a piece starts there, whatever follows.
CUT = re.compile(r"(?<=\S) ")
LIMIT = 1_024


def load(path: str):
    """The tokenizer of a file, one thread for each worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def byte_of_symbol() -> dict[str, int]:
    """The byte that each symbol of byte-level vocabularies stands for: printable Latin-1 bytes stand
    for themselves, the others, in order, for the symbols from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class WordCounts:
    """Token counts of texts, with the counts of words remembered.

    A space after a character that isn't white space always starts a new piece, so a text may be cut
    before it. Texts with any other run of white space before a space are encoded as a whole. Signs
    other than an apostrophe or "<" (of special tokens) behind ASCII letters start a new piece, too.
    """

    PLAIN = re.compile(r"([A-Za-z]+)([!-&(-/:;=-@\[-`{-~]*)")

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.merge = self.tokenizer.model.tokenize
        self.memo, self.letters, self.signs = (Memo(MEMO_WORDS) for _ in range(3))

    def encode(self, texts: list[str]) -> list[int]:
        found: list[int] = []
        for i in range(0, len(texts), BATCH):
            found += map(len, self.tokenizer.encode_batch_fast(texts[i : i + BATCH], add_special_tokens=False))
        return found

    def count_word(self, word: str) -> int:
        """Tokens of a space and ``word``. U+0120 is the vocabulary's symbol for the space."""
        plain = self.PLAIN.fullmatch(word)
        if not plain:
            return self.encode([" " + word])[0]
        letters, signs = plain.groups()
        n = self.letters.get(letters)
        if n is None:
            n = len(self.merge("\u0120" + letters))
            if len(letters) <= MEMO_LENGTH:
                self.letters.put(letters, n)
        if not signs:
            return n
        more = self.signs.get(signs)
        if more is None:
            more = self.encode([signs])[0]
            if len(signs) <= MEMO_LENGTH:
                self.signs.put(signs, more)
        return n + more

    def learn(self, words: list[str]) -> dict[str, int]:
        """Tokens of each word with a space before it; -1 for one that ends in white space or is empty, as the next
        space is no cut then."""
        found = {}
        for w in words:
            n = self.memo.get(w)
            if n is None:
                n = self.count_word(w) if w and not w[-1].isspace() else -1
                if len(w) <= MEMO_LENGTH:
                    self.memo.put(w, n)
            found[w] = n
        return found

    def counts(self, words: list[str]) -> list[int]:
        found = list(map(self.memo.young.get, words))
        if None in found:
            new = self.learn(list({w for w, n in zip(words, found, strict=True) if n is None}))
            found = [new[w] if n is None else n for w, n in zip(words, found, strict=True)]
        return found

    def count(self, text: str) -> int:
        first, *words = text.split(" ")
        counts = self.counts(words)
        # The last word has no cut behind it, so its end matters only inside.
        if not words or min(counts) < 0 or first and first[-1].isspace():
            return self.encode([text])[0]
        return sum(counts) + (self.encode([first])[0] if first else 0)


def _count_small(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = keep(WordCounts, path)
        for batch in batches:
            counts = [counter.count(t.as_py()) for t in batch.column("text")]
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    return run


def _chunks(chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column("row"), batch.column("text"), strict=True):
                text = text.as_py()
                starts = range(0, max(1, len(text) - overlap), chunk - overlap)
                for i in range(0, len(starts), 64):
                    part = starts[i : i + 64]
                    yield pa.record_batch(
                        [
                            pa.array([row.as_py()] * len(part), pa.int64()),
                            pa.array(range(i, i + len(part)), pa.int32()),
                            pa.array(part, pa.int64()),
                            pa.array([s + chunk >= len(text) for s in part]),
                            pa.array([text[s : s + chunk] for s in part]),
                        ],
                        names=["row", "i", "start", "last", "chunk"],
                    )

    return run


def piece_starts(encoding) -> list[tuple[int, int]]:
    """(character, tokens before it) of every place where a piece starts."""
    found, before = [], object()
    for k, (word, (start, _)) in enumerate(zip(encoding.word_ids, encoding.offsets, strict=True)):
        if word is None or word != before:
            found.append((start, k))
        before = word
    return found


def safe_ends(text: str, overlap: int) -> tuple[int, int]:
    """Places of certain cuts, the first behind the left overlap and the last before the right one; 0 and 0 for none."""
    first = CUT.search(text, overlap)
    last = len(text) - overlap
    while last > 0 and not (text[last] == " " and not text[last - 1].isspace()):
        last = text.rfind(" ", 0, last)
    return (first.start(), last) if first and first.start() < last else (0, 0)


def chunk_places(counter: WordCounts, text: str, overlap: int) -> tuple[list, list, int]:
    """Where pieces start in a chunk's left and right overlap, with the tokens before each, and the tokens of all.

    What lies between the overlaps is counted by words; its ends are certain cuts, so that its tokens, and those of
    the parts around it, are the ones of the whole chunk."""
    start, end = safe_ends(text, overlap)
    tokenizer, size = counter.tokenizer, len(text)
    head = tokenizer.encode(text[:start] if end else text, add_special_tokens=False)
    left = piece_starts(head)
    if not end:
        return [p for p in left if p[0] < overlap], [p for p in left if size - overlap <= p[0] <= size - MARGIN], len(head)
    tail = tokenizer.encode(text[end:], add_special_tokens=False)
    before = len(head) + counter.count(text[start:end])
    right = [(end + p, before + k) for p, k in piece_starts(tail)]
    return [p for p in left if p[0] < overlap], [p for p in right if size - overlap <= p[0] <= size - MARGIN], before + len(tail)


def _encode_chunks(path: str, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = keep(WordCounts, path)
        kind = pa.map_(pa.int64(), pa.int64())
        for batch in batches:
            head, tail, total = [], [], []
            for start, text in zip(batch.column("start").to_pylist(), batch.column("chunk").to_pylist(), strict=True):
                left, right, n = chunk_places(counter, text, overlap)
                head.append([(start + p, k) for p, k in left])
                tail.append([(start + p, k) for p, k in right])
                total.append(n)
            yield pa.record_batch(
                [
                    *(batch.column(c) for c in ("row", "i", "last")),
                    pa.array(head, kind),
                    pa.array(tail, kind),
                    pa.array(total, pa.int64()),
                ],
                names=["row", "i", "last", "head", "tail", "total"],
            )

    return run


def _splice(encoded: DataFrame) -> DataFrame:
    """row, n_tokens (null where two chunks have no common place)."""
    after = Window.partitionBy("row").orderBy("i")
    paired = encoded.withColumn("next", F.lead("head").over(after))
    common = F.array_min(F.array_intersect(F.map_keys("tail"), F.map_keys("next")))
    spliced = paired.withColumn("at", F.when(~F.col("last"), common))
    to_here = F.when(F.col("last"), F.col("total")).otherwise(F.try_element_at("tail", F.col("at")))
    skipped = F.when(F.col("last"), F.lit(0)).otherwise(F.try_element_at("next", F.col("at")))
    own = spliced.select("row", (to_here - skipped).alias("n"))
    return own.groupBy("row").agg(
        F.when(F.count("n") == F.count("*"), F.sum("n")).cast("long").alias("n_tokens")
    )


def _count_large(large: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """row, n_tokens of documents (row, text)."""
    done: DataFrame | None = None
    while True:
        cut = large.select("row", "text").mapInArrow(
            _chunks(chunk, overlap), "row long, i int, start long, last boolean, chunk string"
        )
        # A number of tasks by what there is to do, not by bytes: chunks are small and dear.
        chunks = large.agg(F.sum(F.ceil(F.length("text") / (chunk - overlap)))).first()[0] or 1
        spread = cut.repartition(max(1, -(-int(chunks) // CHUNKS)), F.xxhash64("row", "i"))
        encoded = spread.mapInArrow(
            _encode_chunks(path, overlap),
            "row long, i int, last boolean, head map<long,long>, tail map<long,long>, total long",
        )
        counted = stored(_splice(encoded), "token-splices")
        good = counted.where("n_tokens is not null")
        done = good if done is None else done.unionByName(good)
        failed = counted.where("n_tokens is null").select("row")
        if failed.isEmpty():
            return done
        large = large.join(failed, "row", "left_semi")
        chunk, overlap = chunk * 8, overlap * 8


def token_counts(
    docs: DataFrame, path: str, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens)."""
    if not MARGIN < overlap < chunk:
        raise ValueError("an overlap is longer than MARGIN and shorter than a chunk")
    ship(docs.sparkSession)
    rows = docs.select("doc_id", text_of(docs).alias("text")).withColumn("n_bytes", F.octet_length("text").cast("long"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    small = rows.where(F.length("text") <= chunk).mapInArrow(
        _count_small(path), T.StructType([*rows.select("doc_id", "n_bytes").schema, T.StructField("n_tokens", T.LongType())])
    )
    # Long documents are numbered once, in a stored table, as their ids may be missing or repeated.
    numbered = rows.where(F.length("text") > chunk).withColumn("row", F.monotonically_increasing_id())
    large = stored(numbered, "token-large")
    counted = large.select("row", "doc_id", "n_bytes").join(_count_large(large, path, chunk, overlap), "row")
    every = small.unionByName(counted.select(F.col("doc_id").cast(id_type), "n_bytes", "n_tokens"))
    return every.withColumn("over_limit", F.col("n_tokens") > limit)
