"""Toxicity by the nearest labelled examples, in exact TF-IDF cosine over block-max inverted lists.

Terms are all words of the examples, and those first letters of words that go with the label (many toxic
words share a stem). Every word weighs something; how much more a term weighs is learned from the
likelihood ratio of its label counts. Document frequencies of the terms are counted over all documents.
Texts are scored many at once: bounds decide which blocks a text needs, and what frequent terms add to these
is a matrix product; of all blocks at once, without bounds, as long as texts need so many that bounds spare little. A text's score is the distance-weighted vote of its nearest examples, drawn towards the
share of toxic examples; a text without any term gets the share among the examples that have none.

The model is fitted on at most ``examples`` labelled rows, those with the smallest hashed ids; every
document is scored over its whole text. Rows whose crc32(doc_id as text) is divisible by 5 are held
out. Labels other than 0 and 1, and rows without an id, teach nothing; contradicting labels of one
document are averaged. Null and empty texts are scored as texts without terms. Without any labels
every score is 0. Only ``doc_id`` and ``text`` are read; scores depend on the text alone, so a text that is
an example is a neighbour of itself: quality is measured on held-out rows.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from wattline.llm.common import Memo, free, let_go, ship, stored, text_of

#: Labelled rows that the model is fitted on, neighbours that vote.
EXAMPLES, NEIGHBOURS = 8_192, 15
#: Letters of word beginnings; how many times as frequent a term is in toxic texts if its label counts say anything.
PREFIXES, LIFT = range(3, 8), 3.0
#: Likelihood ratio above which the beginning of words is a term of its own, and the weight of any word beside that of
#: the term with the highest ratio.
RATIO, LEAST = 0.0, 0.025
#: Examples of a block of the inverted lists, and blocks that are looked at together first.
BLOCK, FIRST = 64, 4
#: A term in one of so many examples, of at most so many terms, has its weights in a matrix, too; texts that are scored,
#: and counted, at once.
DENSE, MOST_DENSE, QUERIES, TEXTS = 32, 1_024, 128, 256
#: Share of blocks from which on all are looked at; bounds are tried again after so many times.
SHARE, AGAIN = 0.25, 64
#: Texts whose lists of rarer terms are added up at once, and postings whose blocks are looked for: a worker's memory.
FEW, PIECE = 16, 200_000
#: Rows that Spark and a worker hand each other at once: both hold them.
ROWS = 1_024
FOLDS = 5
#: Words that are no terms whose beginnings a worker remembers in each of two generations.
MEMO = 50_000

WORD = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def word_terms(word: str) -> list[str]:
    return [word + "$", *(word[:n] for n in PREFIXES if len(word) > n)]


class Terms:
    """Finds the terms of a model in texts. Sent as the terms alone; each worker prepares its tables once."""

    def __init__(self, chosen: list[str]):
        self.chosen, self.size, self.words = "\n".join(chosen), len(chosen), None

    def _prepare(self) -> None:
        chosen = self.chosen.split("\n")
        self.words = {t[:-1]: i for i, t in enumerate(chosen) if t.endswith("$")}
        self.beginnings = {t: i for i, t in enumerate(chosen) if not t.endswith("$")}
        self.memo = Memo(MEMO)
        #: Beginnings of all words that are terms; word i has those from start[i] to start[i + 1].
        self.start, own = np.zeros(self.size + 1, np.int64), array("i")
        for word, i in self.words.items():
            found = self._of(word)
            self.start[i + 1] = len(found)
            own.extend(found)
        self.start, self.own, self.chosen = np.cumsum(self.start), np.array(own, np.int32), None

    def _of(self, word: str) -> list[int]:
        return [self.beginnings[t] for t in word_terms(word)[1:] if t in self.beginnings]

    def _of_other(self, word: str) -> list[int]:
        """The beginnings of a word that isn't a term."""
        found = self.memo.get(word)
        if found is None:
            found = self._of(word)
            if len(word) <= 64:
                self.memo.put(word, found)
        return found

    def lists(self, texts: pa.Array) -> list[pa.Array]:
        """Terms, ascending, and how often each occurs, of every text."""
        if self.words is None:
            self._prepare()
        sizes, *numbers = self._lists(texts)
        at = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
        return [pa.ListArray.from_arrays(at, pa.array(x)) for x in numbers]

    def _lists(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of terms of every text; terms; counts."""
        sizes, words, times, more = [], array("i"), array("i"), []
        get, unknown = self.words.get, repeat(-1)
        for i, text in enumerate(texts):
            counts = Counter(WORD.findall(text.as_py().lower()))
            found = list(map(get, counts, unknown))
            sizes.append(len(found))
            words.extend(found)
            times.extend(counts.values())
            if -1 in found:
                more += [(i, t, n) for (word, n), w in zip(counts.items(), found, strict=True) if w < 0 for t in self._of_other(word)]
        word, n, of = np.array(words, np.int32), np.array(times, np.int32), np.repeat(np.arange(len(sizes)), sizes)
        word, n, of = word[word >= 0], n[word >= 0], of[word >= 0]
        at, part = spread(self.start[word], self.start[word + 1])
        others = np.array(more, np.int64).reshape(-1, 3)
        key = np.concatenate([of, of[part], others[:, 0]]) * self.size + np.concatenate([word, self.own[at], others[:, 1]])
        order = np.argsort(key)
        key, n = key[order], np.concatenate([n, n[part], others[:, 2]])[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        counts = np.add.reduceat(n, first) if len(key) else n
        text, term = np.divmod(key[first], max(1, self.size))
        return np.bincount(text, minlength=len(sizes)).astype(np.int32), term.astype(np.int32), counts.astype(np.int32)


def spread(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All positions of ranges, and the range that each is from."""
    sizes = end - start
    of = np.repeat(np.arange(len(start)), sizes)
    return np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + start[of], of


class BlockMaxIndex:
    """Inverted lists of examples in blocks, with each term's largest weight in each block it occurs in."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], terms: int):
        """Of (terms, weights) of each example."""
        # Like vectors next to each other, by their heaviest terms, so that most blocks have low bounds for a query.
        heavy = [t[np.lexsort((t, -w))[:8]].tolist() for t, w in vectors]
        self.order = np.array(sorted(range(len(vectors)), key=lambda i: (heavy[i], i)), dtype=np.int64)
        self.blocks = max(1, -(-len(vectors) // BLOCK))
        place = np.repeat(np.arange(len(vectors), dtype=np.int32), [len(vectors[i][0]) for i in self.order])
        term, weight = (np.concatenate([np.zeros(0, kind), *(vectors[i][k] for i in self.order)]) for k, kind in ((0, np.int32), (1, np.float64)))
        #: Postings of each term; rows of the frequent terms, -1 for the others.
        self.postings = np.bincount(term, minlength=terms)
        often = np.flatnonzero(self.postings * DENSE >= max(1, len(vectors)))
        self.often = np.sort(often[np.argsort(-self.postings[often], kind="stable")[:MOST_DENSE]])
        self.row = np.full(terms, -1, np.int32)
        self.row[self.often] = np.arange(len(self.often))
        #: Postings by term, then place; those of the frequent terms last.
        by = np.lexsort([place, term, self.row[term] >= 0])
        self.place, self.weight = place[by].astype(np.min_scalar_type(len(vectors))), weight[by]
        self.tables = None
        #: Share of blocks that bounds left when they were tried, and how often all blocks were looked at since.
        self.share, self.since = 0.0, 0

    def __getstate__(self) -> dict:
        return self.__dict__ | {"tables": None}

    def _tables(self) -> tuple[np.ndarray, ...]:
        """What follows from the postings, made when needed: where each rarer term's blocks start; a block's number, where
        its postings start, and their largest weight; weights and largest weights of the frequent terms as matrices."""
        if self.tables is None:
            sizes = np.where(self.row < 0, self.postings, 0)
            end = np.r_[0, np.cumsum(sizes)]
            rarer, first, n = int(end[-1]), np.zeros(len(sizes) + 1, np.int64), 0
            block, start, largest = (np.empty(rarer + 1, kind) for kind in (np.int16, np.int32, np.float64))
            cuts = np.unique(np.r_[0, np.searchsorted(end, range(PIECE, rarer, PIECE)), len(sizes)]).tolist()
            for a, b in zip(cuts, cuts[1:]):  # a worker's memory
                own = slice(end[a], end[b])
                key = np.repeat(np.arange(a, b) * self.blocks, sizes[a:b]) + self.place[own] // BLOCK
                at = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
                term, part = np.divmod(key[at], self.blocks)
                first[a + 1 : b + 1] = n + np.cumsum(np.bincount(term - a, minlength=b - a))
                found, n = slice(n, n + len(at)), n + len(at)
                block[found], start[found] = part, end[a] + at
                if len(at):
                    largest[found] = np.maximum.reduceat(self.weight[own], at)
            start[n] = rarer
            dense = np.zeros((len(self.often), self.blocks * BLOCK))
            ends = rarer + np.cumsum(self.postings[self.often])
            for row, (end, size) in enumerate(zip(ends.tolist(), self.postings[self.often].tolist(), strict=True)):
                dense[row, self.place[end - size : end]] = self.weight[end - size : end]
            most = dense.reshape(len(self.often), self.blocks, BLOCK).max(axis=2, initial=0.0)
            self.tables = first, block, start, largest, dense, most
        return self.tables

    def let_go(self) -> None:
        """Of the tables, which are several times as large as the postings."""
        self.tables = None

    def nearest_each(self, query: np.ndarray, terms: np.ndarray, weights: np.ndarray, n: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, cosine, example) of the ``k`` largest cosines above 0 of each of ``n`` queries, best first, ties to
        the smaller example; a query's terms and weights are those with its number in ``query``, which ascends."""
        first_block, block_of, start, largest, dense, most = self._tables()
        width, row = self.blocks * BLOCK, self.row[terms]
        common = row >= 0
        heavy = np.zeros((n, len(dense)))
        heavy[query[common], row[common]] = weights[common]
        query, terms, weights = query[~common], terms[~common], weights[~common]
        pruned = self.share < SHARE or self.since >= AGAIN
        bounds, score = heavy @ most if pruned else None, np.zeros((n, width))
        for i in range(0, n, FEW):
            few, own = min(FEW, n - i), slice(*np.searchsorted(query, (i, i + FEW)))
            low, high, asks, times = first_block[terms[own]], first_block[terms[own] + 1], query[own] - i, weights[own]
            if pruned:
                at, of = spread(low, high)
                bound = np.bincount(asks[of] * self.blocks + block_of[at], times[of] * largest[at], few * self.blocks)
                bounds[i : i + few] += bound.reshape(few, self.blocks)
            at, of = spread(start[low], start[high])
            found = np.bincount(asks[of] * width + self.place[at], times[of] * self.weight[at], few * width)
            score[i : i + few] = found.reshape(few, width)

        def finish(wanted: np.ndarray) -> None:
            """Adds the frequent terms in the wanted blocks of each query."""
            for block in np.flatnonzero(wanted.any(axis=0)).tolist():
                own, part = np.flatnonzero(wanted[:, block]), slice(block * BLOCK, (block + 1) * BLOCK)
                if len(own) == n:
                    score[:, part] += heavy @ dense[:, part]
                else:
                    score[own, part] += heavy[own] @ dense[:, part]

        if pruned:
            # First the blocks with the highest bounds; their k-th score is what the others' bounds must reach.
            order = np.argsort(-bounds, axis=1, kind="stable")[:, :FIRST]
            first = np.zeros(bounds.shape, bool)
            np.put_along_axis(first, order, True, axis=1)
            finish(first)
            some = np.take_along_axis(score.reshape(n, self.blocks, BLOCK), order[:, :, None], axis=1).reshape(n, -1)
            least = np.partition(some, -k, axis=1)[:, -k] - 1e-9 if some.shape[1] >= k else np.zeros(n)
            more = ~first & (bounds > 0) & (bounds >= least[:, None])
            finish(more)
            self.share, self.since = float((first | more).mean()) if n else 0.0, 0
        else:
            score += heavy @ dense
            least = np.partition(score, -k, axis=1)[:, -k] - 1e-9 if width >= k else np.zeros(n)
            self.since += 1
        # What other blocks have of the rarer terms is below their bounds.
        found, place = np.nonzero(score >= np.maximum(least, 1e-12)[:, None])
        score, example = np.round(score[found, place], 12), self.order[place]
        best = np.lexsort((example, -score, found))
        best = best[score[best] > 0]
        found = found[best]
        rank = np.arange(len(found)) - np.searchsorted(found, found)
        keep = best[rank < k]
        return found[rank < k], score[keep], example[keep]

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int) -> list[tuple[float, int]]:
        """The ``k`` largest (cosine, example) above 0 of one query."""
        _, score, example = self.nearest_each(np.zeros(len(terms), np.int64), terms, weights, 1, k)
        return list(zip(score.tolist(), example.tolist(), strict=True))


class Model:
    """Scores texts; holds at most EXAMPLES examples over their own terms."""

    def __init__(self, chosen: list[str], weights: np.ndarray, examples: list[tuple[int, np.ndarray, np.ndarray, float]]):
        """Examples are (doc id, terms, counts, label)."""
        self.chosen, self.weights = chosen, weights
        examples = sorted(examples, key=lambda e: e[0])
        labels = [y for *_, y in examples]
        empty = [y for _, terms, _, y in examples if not len(terms)]
        self.base = sum(labels) / len(labels) if labels else 0.0
        # With few such examples their share is uncertain; at least the base rate's weight of one example.
        self.empty = (sum(empty) + self.base) / (len(empty) + 1)
        some = [e for e in examples if len(e[1])]
        self.ids, self.labels = [e[0] for e in some], [e[3] for e in some]
        self.index = BlockMaxIndex([(terms, self.vector(terms, counts)) for _, terms, counts, _ in some], len(chosen))

    def __getstate__(self) -> dict:
        return self.__dict__ | {"chosen": []}  # scoring goes by their numbers

    def vector(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        raw = (1 + np.log(counts)) * self.weights[terms]
        return raw / np.sqrt((raw * raw).sum())

    def score_each(self, ends: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, list[list[int]]]:
        """Scores of texts and the examples (doc ids) that speak most for each; text i has the terms from ends[i] to
        ends[i + 1]."""
        scores, evidence = [np.zeros(0)], []
        for i in range(0, len(ends) - 1, QUERIES):
            own = ends[i : i + QUERIES + 1]
            part = slice(own[0], own[-1])
            found, best = self._score(np.diff(own), terms[part], counts[part])
            scores.append(found)
            evidence += best
        return np.concatenate(scores), evidence

    def _score(self, sizes: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, list[list[int]]]:
        n = len(sizes)
        if not self.ids:
            return np.full(n, self.empty), [[] for _ in range(n)]
        query = np.repeat(np.arange(n), sizes)
        raw = (1 + np.log(counts)) * self.weights[terms]
        norm = np.sqrt(np.bincount(query, raw * raw, n))
        of, cosine, example = self.index.nearest_each(query, terms, raw / norm[query], n, NEIGHBOURS)
        vote = 1 / (1.05 - cosine)
        toxic = np.bincount(of, vote * np.array(self.labels, np.float64)[example], n) + self.base
        score = np.where(sizes > 0, toxic / (np.bincount(of, vote, n) + 1), self.empty)
        start = np.searchsorted(of, np.arange(n + 1)).tolist()
        return score, [[self.ids[e] for e in example[a : min(a + 3, b)]] for a, b in zip(start, start[1:])]

    def score(self, terms: np.ndarray, counts: np.ndarray) -> tuple[float, list[int]]:
        """Score and evidence of one text."""
        score, evidence = self.score_each(np.array([0, len(terms)]), terms, counts)
        return float(score[0]), evidence[0]


def _labelled(docs: DataFrame, labels: DataFrame, examples: int) -> DataFrame:
    """doc_id, text, toxic of the examples; at most ``examples`` different ids."""
    known = labels.select("doc_id", "toxic").where("doc_id is not null and toxic in (0, 1)")
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.avg("toxic").alias("toxic"))
    # Only ids of documents that are there, so the sample is full whatever part of a corpus is scored.
    known = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    some = stored(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples), "toxic-labels")
    texts = docs.select("doc_id", text_of(docs).alias("text")).join(F.broadcast(some), "doc_id")
    return stored(texts.dropDuplicates(["doc_id", "text"]), "toxic-examples")


def _choose(examples: DataFrame) -> tuple[list[str], np.ndarray]:
    """Terms of the examples, as many as they hold, and each term's likelihood ratio; 0 if it doesn't go with the label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, every = Counter(), Counter()
        for batch in batches:
            for text, y in zip(batch.column("text"), batch.column("toxic").to_pylist(), strict=True):
                own = {t for w in set(WORD.findall(text.as_py().lower())) for t in word_terms(w)}
                every.update(own)
                if y >= 0.5:
                    toxic.update(own)
        names = list(every)
        yield pa.record_batch(
            [pa.array(names, pa.string()), pa.array([toxic[t] for t in names], pa.int64()), pa.array(every.values(), pa.int64())],
            names=["term", "pos", "all"],
        )

    found = examples.mapInArrow(run, "term string, pos long, `all` long")
    totals = examples.agg(F.sum((F.col("toxic") >= 0.5).cast("long")), F.count("*")).first()
    positive, rows = totals[0] or 0, totals[1]
    if not rows:
        return [], np.zeros(0)
    base = positive / rows
    counted = found.groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("all").alias("all"))
    neg = F.col("all") - F.col("pos")
    part = lambda n, share: F.when(n > 0, n * F.log(n / (F.col("all") * share))).otherwise(0.0)
    ratio = 2 * (part(F.col("pos"), base) + part(neg, 1 - base)) if 0 < base < 1 else F.lit(0.0)
    lifted = F.col("pos") * (rows - positive) >= LIFT * neg * positive
    scored = counted.withColumn("ratio", F.when(lifted, F.greatest(ratio, F.lit(0.0))).otherwise(0.0))
    kept = scored.where(F.col("term").endswith("$") | (F.col("ratio") > RATIO)).select("term", "ratio")
    got = stored(kept, "toxic-terms").orderBy("term").toArrow()
    return got.column("term").to_pylist(), got.column("ratio").to_numpy()


def _term_counts(docs: DataFrame, chosen: list[str]) -> DataFrame:
    """doc_id, key (hash of the text), terms, counts of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(Terms(chosen))
    rows = docs.select("doc_id", _key(docs).alias("key"), text_of(docs).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for part in (batch.slice(i, TEXTS) for i in range(0, batch.num_rows, TEXTS)):
                kept = [part.column("doc_id"), part.column("key")]
                yield pa.record_batch([*kept, *sent.value.lists(part.column("text"))], names=["doc_id", "key", "terms", "counts"])

    numbers = T.ArrayType(T.IntegerType())
    fields = [T.StructField("terms", numbers), T.StructField("counts", numbers)]
    return stored(rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], rows.schema["key"], *fields])), "toxic-counts", ROWS)


def _key(docs: DataFrame) -> Column:
    return F.unhex(F.md5(text_of(docs)))


def fit(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> tuple[Model, DataFrame]:
    """The model, and the stored term counts of all documents."""
    ship(docs.sparkSession)
    some = _labelled(docs, labels, examples)
    chosen, ratio = _choose(some)
    counted = _term_counts(docs, chosen)
    total = counted.count()
    seen = np.zeros(len(chosen))
    found = counted.select(F.explode("terms").alias("t")).groupBy("t").count().toArrow()  # the examples' terms at most
    seen[found.column("t").to_numpy()] = found.column("count").to_numpy()
    learned = np.sqrt(ratio / ratio.max()) if len(ratio) and ratio.max() > 0 else np.zeros(len(chosen))
    weights = (np.log((1 + total) / (1 + seen)) + 1) * (learned + [LEAST * t.endswith("$") for t in chosen])
    vectors = counted.join(F.broadcast(some.select("doc_id", "toxic").distinct()), "doc_id")
    # An id's rows with one set of counts are one example: EXAMPLES rows, unless ids repeat.
    got = vectors.dropDuplicates(["doc_id", "terms", "counts"]).orderBy("doc_id", "terms", "counts").limit(2 * examples)
    rows = got.select("doc_id", "terms", "counts", "toxic").toArrow()
    values = [[x.values.to_numpy() for x in rows.column(c)] for c in ("terms", "counts")]
    ids, toxic = rows.column("doc_id").to_pylist(), rows.column("toxic").to_pylist()
    return Model(chosen, weights, list(zip(ids, *values, toxic, strict=True))), counted


def _score_batches(sent: Broadcast, column: str, ids: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        model = sent.value
        try:
            for batch in batches:
                terms, counts = batch.column("terms"), batch.column("counts")
                found, best = model.score_each(terms.offsets.to_numpy(), terms.values.to_numpy(), counts.values.to_numpy())
                evidence = pa.array(best, ids)
                yield pa.record_batch([batch.column(column), pa.array(found, pa.float64()), evidence], names=[column, "score", "evidence"])
        finally:
            model.index.let_go()  # workers wait for the next task in turn, more of them than run at once

    return run


def _scores(model: Model, counted: DataFrame, column: str) -> DataFrame:
    """A column of ``counted``, score, evidence of every row."""
    sent = counted.sparkSession.sparkContext.broadcast(model)

    id_type = counted.schema["doc_id"].dataType
    run = _score_batches(sent, column, pa.list_(to_arrow_type(id_type)))
    fields = [T.StructField("score", T.DoubleType()), T.StructField("evidence", T.ArrayType(id_type))]
    return counted.select("terms", "counts", column).mapInArrow(run, T.StructType([counted.schema[column], *fields]))


def toxicity(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, evidence (ids of the nearest examples)."""
    scored = _scores(*fit(docs, labels, examples), "doc_id")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence"
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> DataFrame:
    """The documents, in all their columns, with a score under 0.5.

    A score depends on the text alone, so the documents that go are told by the hashes of their texts."""
    model, counted = fit(docs, labels, examples)
    toxic = stored(_scores(model, counted, "key").where("score >= 0.5").select("key").distinct(), "toxic-keys", ROWS)
    free(counted)
    return docs.join(toxic, _key(docs) == toxic["key"], "left_anti")
