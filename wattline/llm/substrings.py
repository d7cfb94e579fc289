"""Substring de-duplication by seed and extend on word sequences.

Words are what stands between white space, unchanged. A window is ``length`` consecutive words. A word
is removed if a window over it also starts in a document with a smaller id.

* Seeds: of the k-word grams inside a window the one with the smallest hash is its anchor. Equal
  windows have equal anchors, so documents are joined on anchors only (winnowing).
* Extension: every place of an anchor is extended both ways as far as any window over it reaches.
  Places with one anchor and one such context are alike; all but those of the smallest id are covered
  over that whole reach. Only where an anchor has several contexts, the windows of one document of
  each context are compared, by 128-bit hash.
* What overlapping repeats cover is merged: the maximal repeats of at least ``length`` words.

All steps are linear in the number of places, whatever the number of documents that share a passage.
Null texts have no words. Rows without an id lose nothing and remove nothing; rows that share an id
do not remove each other's words. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.llm.common import join_groups, likely, ship, stored, text_of

#: Words of a window and of an anchor.
LENGTH, GRAM = 50, 20
#: Odd multipliers of the three sequence hashes: anchors and contexts; windows use the last two.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)


class Sequence:
    """The words of a text with hashes of all their runs in constant time each."""

    def __init__(self, text: str):
        self.words = text.encode().split()
        self.n = len(self.words)
        self._hashes: np.ndarray | None = None
        self._sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def runs(self, base: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of words start..end-1: a polynomial in ``base`` modulo 2**64."""
        if self._hashes is None:
            self._hashes = np.fromiter(map(xxhash.xxh64_intdigest, self.words, repeat(7)), np.uint64, self.n)
        if base not in self._sums:
            powers = np.full(self.n + 1, base, dtype=np.uint64)
            inverses = np.full(self.n + 1, pow(base, -1, 1 << 64), dtype=np.uint64)
            powers[0] = inverses[0] = 1
            np.multiply.accumulate(powers, out=powers)
            np.multiply.accumulate(inverses, out=inverses)
            sums = np.zeros(self.n + 1, dtype=np.uint64)
            np.cumsum(self._hashes * powers[:-1], out=sums[1:])
            self._sums[base] = (sums, inverses)
        sums, inverses = self._sums[base]
        h = (sums[end] - sums[start]) * inverses[start]
        h = (h ^ (h >> np.uint64(32))) * np.uint64(BASES[0])
        return h ^ (h >> np.uint64(29))

    def anchors(self, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
        """The hash of every gram, and where the anchor of every window starts."""
        if self.n < length:
            return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
        at = np.arange(self.n - gram + 1)
        grams = self.runs(BASES[0], at, at + gram)
        least = sliding_window_view(grams, length - gram + 1).argmin(axis=1)
        return grams, least + np.arange(len(least))


def _places(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, columns = [], [[], [], []]
            for i, text in enumerate(batch.column("text")):
                sequence = Sequence(text.as_py())
                grams, anchors = sequence.anchors(length, gram)
                at = np.unique(anchors)
                if not len(at):
                    continue
                low = np.maximum(at - (length - gram), 0)
                high = np.minimum(at + length, sequence.n)
                context = sequence.runs(BASES[1], low, high)
                # How far a context reaches is part of it.
                context = context + ((at - low) * 4096 + (high - at)).astype(np.uint64) * np.uint64(BASES[2])
                rows.append(np.full(len(at), i))
                for column, values in zip(columns, (grams[at], context, at), strict=True):
                    column.append(values)
            if rows:
                own = batch.select(["doc_id", "version"]).take(pa.array(np.concatenate(rows)))
                a, c, at = (np.concatenate(x) for x in columns)
                arrays = [*own.columns, pa.array(a.view(np.int64)), pa.array(c.view(np.int64)), pa.array(at, pa.int32())]
                yield pa.record_batch(arrays, names=["doc_id", "version", "a", "c", "at"])

    return run


def _windows(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                sequence = Sequence(batch.column("text")[i].as_py())
                _, anchors = sequence.anchors(length, gram)
                wanted = np.array(batch.column("wanted")[i].as_py(), dtype=np.int64)
                start = np.flatnonzero(np.isin(anchors, wanted))
                hashes = [sequence.runs(b, start, start + length).view(np.int64) for b in BASES[1:]]
                own = batch.select(["doc_id", "version"]).take(pa.array(np.full(len(start), i)))
                arrays = [*own.columns, pa.array(start, pa.int32()), *map(pa.array, hashes)]
                yield pa.record_batch(arrays, names=["doc_id", "version", "start", "w1", "w2"])

    return run


def _covered(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """doc_id, version, spans: [start, end) of repeats, for documents (doc_id, version, text) with any.

    ``version`` tells rows apart that share an id.
    """
    key = rows.select("doc_id", "version").schema
    fields = [T.StructField(c, T.LongType()) for c in ("a", "c")]
    source = rows.where(F.col("doc_id").isNotNull())
    places = stored(
        source.mapInArrow(_places(length, gram), T.StructType([*key, *fields, T.StructField("at", T.IntegerType())])),
        "repeat-places",
    )
    shared = stored(
        places.groupBy("a").agg(F.count("*").alias("n"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
        .where("lo < hi").select("a", "n"),
        "repeat-anchors",
    )
    seeds = stored(join_groups(places, shared, ["a"], ["doc_id", "at"]).drop("n"), "repeat-seeds")
    contexts = stored(
        seeds.groupBy("a", "c").agg(F.count("*").alias("places"), F.min("doc_id").alias("low")), "repeat-contexts"
    )
    variants = stored(contexts.groupBy("a").agg(F.count("*").alias("n")), "repeat-variants")
    groups = stored(
        join_groups(contexts, variants, ["a"], ["c"]).select("a", "c", "low", F.col("places").alias("n"), F.col("n").alias("variants")),
        "repeat-groups",
    )
    judged = stored(join_groups(seeds, groups, ["a", "c"], ["doc_id", "at"]), "repeat-judged")
    reach = judged.where("doc_id > low").select(
        "doc_id", "version", F.greatest(F.col("at") - (length - gram), F.lit(0)).alias("start"), (F.col("at") + length).alias("end")
    )
    wanted = judged.where("doc_id = low and variants > 1").groupBy("doc_id", "version").agg(F.collect_set("at").alias("wanted"))
    wanted = stored(wanted, "repeat-wanted")
    hashes = [T.StructField("start", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in ("w1", "w2"))]
    windows = stored(
        likely(source, wanted, ["doc_id", "version"]).join(wanted, ["doc_id", "version"]).select("doc_id", "version", "text", "wanted").mapInArrow(
            _windows(length, gram), T.StructType([*key, *hashes])
        ),
        "repeat-windows",
    )
    equal = stored(
        windows.groupBy("w1", "w2").agg(F.count("*").alias("n"), F.min("doc_id").alias("low")).where("n > 1"), "repeat-equal"
    )
    repeated = join_groups(windows, equal, ["w1", "w2"], ["doc_id", "start"]).where("doc_id > low").select(
        "doc_id", "version", "start", (F.col("start") + length).alias("end")
    )
    spans = reach.unionByName(repeated).groupBy("doc_id", "version").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    return stored(spans, "repeat-spans")


def _removed(n: int, spans) -> np.ndarray:
    """For each of ``n`` words whether a span covers it."""
    steps = np.zeros(n + 1, dtype=np.int64)
    for span in spans or ():
        steps[min(span["start"], n)] += 1
        steps[min(span["end"], n)] -= 1
    return np.cumsum(steps)[:n] > 0


def _with_spans(docs: DataFrame, length: int, gram: int, *more) -> DataFrame:
    ship(docs.sparkSession)
    rows = docs.select("doc_id", text_of(docs).alias("text"), *more).withColumn("version", F.xxhash64("text"))
    spans = _covered(rows.select("doc_id", "version", "text"), length, gram)
    return rows.join(spans, ["doc_id", "version"], "left")


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (of the kept words, one space apart)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, gone, digests = [], [], []
            for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
                words = text.as_py().encode().split()
                total.append(len(words))
                removed = _removed(len(words), spans.as_py()) if spans.is_valid else np.empty(0, dtype=bool)
                gone.append(int(removed.sum()))
                if gone[-1]:
                    words = [w for w, r in zip(words, removed.tolist(), strict=True) if not r]
                digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    joined = _with_spans(docs, length, gram).select("doc_id", "text", "spans")
    numbers = [T.StructField(c, T.LongType()) for c in ("n_words", "n_removed")]
    return joined.mapInArrow(
        run, T.StructType([joined.schema["doc_id"], *numbers, T.StructField("kept_sha256", T.StringType())])
    )


def _cut(text: str, spans) -> str:
    """``text`` without the words in ``spans``; runs of kept words keep their own white space."""
    words, at, place = text.encode().split(), 0, []
    raw = text.encode()
    for w in words:
        at = raw.index(w, at)
        place.append((at, at + len(w)))
        at += len(w)
    removed, kept, i = _removed(len(words), spans), [], 0
    while i < len(words):
        j = i
        while j < len(words) and removed[j] == removed[i]:
            j += 1
        if not removed[i]:
            kept.append(raw[place[i][0] : place[j - 1][1]])
        i = j
    return b" ".join(kept).decode()


def drop_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """The documents, in all their columns, without repeated passages. Texts that lose nothing stay as
    they are, null included; ``n_chars``, if there, is counted again for the others. A document of which
    nothing is left stays with an empty text."""
    joined = _with_spans(docs, length, gram, F.struct(*[docs[c] for c in docs.columns]).alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                _cut(t.as_py(), s.as_py()) if s.is_valid else None
                for t, s in zip(batch.column("text"), batch.column("spans"), strict=True)
            ]
            yield pa.record_batch([batch.column("row"), pa.array(texts, pa.string())], names=["row", "left"])

    left = joined.select("row", "text", "spans").mapInArrow(
        run, T.StructType([joined.select("row").schema["row"], T.StructField("left", T.StringType())])
    )
    changed = F.col("left").isNotNull()
    kinds = {f.name: f.dataType for f in docs.schema}

    def column(name: str):
        old = F.col("row").getField(name)
        if name == "text":
            return F.when(changed, F.col("left")).otherwise(old).cast(kinds[name]).alias(name)
        if name == "n_chars":
            return F.when(changed, F.length("left")).otherwise(old).cast(kinds[name]).alias(name)
        return old.alias(name)

    return left.select(*[column(c) for c in docs.columns])
