import pickle
import random
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from wattline.llm import common, queries, toxicity


def test_index_returns_the_exact_nearest():
    rng = random.Random(4)
    vectors = [{t: rng.random() for t in rng.sample(range(40), rng.randint(1, 6))} for _ in range(500)]
    vectors += [dict(vectors[3]) for _ in range(40)]  # ties
    index = toxicity.BlockMaxIndex([(np.array(list(v)), np.array(list(v.values()))) for v in vectors], 40)
    for _ in range(60):
        query = {t: rng.random() for t in rng.sample(range(40), rng.randint(1, 5))}
        dots = [(-round(sum(w * v.get(t, 0.0) for t, w in query.items()), 12), i) for i, v in enumerate(vectors)]
        want = sorted(d for d in dots if d[0] < 0)[:15]
        got = index.nearest(np.array(list(query)), np.array(list(query.values())), 15)
        assert [i for _, i in got] == [i for _, i in want]
        assert [s for s, _ in got] == pytest.approx([-s for s, _ in want])


def test_bounds_that_spare_little_are_left_out_for_a_while(monkeypatch):
    monkeypatch.setattr(toxicity, "AGAIN", 2)
    rng = np.random.default_rng(5)
    dense = rng.random((1_000, 40)) * (rng.random((1_000, 40)) < 0.3)
    vectors = [(np.flatnonzero(v), v[np.flatnonzero(v)]) for v in dense]
    index = toxicity.BlockMaxIndex(vectors, 40)
    seen = []
    for queries in rng.random((4, 6, 40)):
        of, terms = np.nonzero(queries)
        query, score, example = index.nearest_each(of, terms, queries[of, terms], 6, 15)
        seen.append(index.since)
        by_hand = np.round(queries @ dense.T, 12)
        for q in range(6):
            best = sorted(range(1_000), key=lambda e: (-by_hand[q, e], e))[:15]
            assert example[query == q].tolist() == best
            assert np.allclose(score[query == q], by_hand[q, best], atol=1e-11)
    assert seen == [0, 1, 2, 0] and index.share >= toxicity.SHARE


def test_many_queries_at_once_by_frequent_and_rare_terms(monkeypatch):
    rng = random.Random(14)
    vectors = [{t: rng.random() for t in {rng.randrange(12), *(int(300 * rng.random() ** 2) for _ in range(9))}} for _ in range(700)]
    vectors += [dict(vectors[5]) for _ in range(30)]  # ties
    queries = [{t: rng.random() for t in rng.sample(range(300), rng.randint(0, 12))} for _ in range(50)] + [vectors[5]]
    of = np.repeat(np.arange(len(queries)), [len(q) for q in queries])
    terms, weights = np.array([t for q in queries for t in q]), np.array([w for q in queries for w in q.values()])
    for share, most in ((1, 0), (16, 10), (64, 1_000), (1_000, 1_000)):
        monkeypatch.setattr(toxicity, "DENSE", share)
        monkeypatch.setattr(toxicity, "MOST_DENSE", most)
        index = toxicity.BlockMaxIndex([(np.array(list(v)), np.array(list(v.values()))) for v in vectors], 300)
        query, score, example = index.nearest_each(of, terms, weights, len(queries), 15)
        for i, q in enumerate(queries):
            dots = [(-round(sum(w * v.get(t, 0.0) for t, w in q.items()), 12), j) for j, v in enumerate(vectors)]
            want = sorted(d for d in dots if d[0] < 0)[:15]
            assert example[query == i].tolist() == [j for _, j in want]
            assert score[query == i] == pytest.approx([-s for s, _ in want])


def test_a_worker_that_waits_holds_postings_alone():
    rng = random.Random(21)
    examples = [(i, np.array(sorted({*rng.sample(range(20), 8), *rng.sample(range(20, 5_000), 30)}), np.int32)) for i in range(2_000)]
    model = toxicity.Model([f"w{i}$" for i in range(5_000)], np.ones(5_000), [(i, t, np.ones(len(t), np.int32), i % 2) for i, t in examples])
    postings = sum(len(t) for _, t in examples)
    assert len(pickle.dumps(model.index)) < 11 * postings + 100_000  # eight bytes of weight, two of place
    assert common.keep(list, "abc") is common.keep(list, "abc")
    texts = pa.record_batch([[7, 8], [t for _, t in examples[:2]], [np.ones(len(t), np.int32) for _, t in examples[:2]]], names=["doc_id", "terms", "counts"])
    run = toxicity._score_batches(SimpleNamespace(value=model), "doc_id", pa.list_(pa.int64()))
    batches = run(iter([texts, texts]))
    first = next(batches)
    assert first.column("evidence").to_pylist()[1][0] == 1 and not common._KEPT and model.index.tables is not None
    assert next(batches).equals(first) and list(batches) == [] and model.index.tables is None


def test_terms_of_texts_are_counted_as_one_by_one():
    chosen = sorted({"grimlok$", "grim", "griml", "nasty$", "nas", "té$", "a$"})
    texts = ["Grimlok grimlok GRIMSTY", "", "nasty Té a nas x9grim", "none of them", "grim grimm", "", "", "nasty " * 5]
    terms, counts = toxicity.Terms(chosen).lists(pa.array(texts))
    for text, got in zip(texts, map(dict, map(zip, terms.to_pylist(), counts.to_pylist())), strict=True):
        found = [t for w in toxicity.WORD.findall(text.lower()) for t in toxicity.word_terms(w) if t in chosen]
        assert got == {chosen.index(t): found.count(t) for t in sorted(set(found))} and list(got) == sorted(got)
    assert [x.to_pylist() for x in toxicity.Terms(chosen).lists(pa.array([], pa.string()))] == [[], []]


def corpus(n=600):
    rng = random.Random(8)
    vocabulary = [f"{a}{b}{c}" for a in ("ba", "ke", "lo") for b in ("mi", "su", "té") for c in ("n", "rak", "vo")]
    docs, labels = [], []
    for i in range(n):
        words = rng.choices(vocabulary, k=rng.randint(20, 60))
        toxic = rng.random() < 0.2
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["VILE!", "nasty", "grimlok", "grimsty", "grimz."])
        docs.append((i, " ".join(words), "x", 0.5))
        if i % 3:
            labels.append((i, 1, int(toxic)))
    truth = {i: y for i, _, y in labels}
    return docs, labels, truth


def test_held_out_rows_are_recognised(spark):
    docs, labels, truth = corpus()
    docs += [(None, "nasty", "x", 0.5), (9_000, None, "x", 0.5), (9_001, "", "x", 0.5), (1, docs[1][1], "x", 0.5)]
    labels += [(None, 1, 1), (5, 1, None), (7_777, None, 1), (6, 1, 3)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, terms string, score double")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = toxicity.toxicity(frame, known).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[None].predicted == 1 and by_id[9_000].score == by_id[9_001].score < 0.5
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert len(held) > 40 and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    held_ids = {r.doc_id for r in rows if r.held_out}
    assert all(not held_ids & set(r.evidence) for r in rows)
    kept = toxicity.drop_toxic(frame, known)
    assert kept.columns == frame.columns
    want = sorted((r.doc_id is None, r.doc_id or 0) for r in rows if not r.predicted)
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == want


def test_labels_of_held_out_rows_teach_nothing(spark):
    docs, labels, _ = corpus(200)
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, score double")
    flipped = [(i, q, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, q, y in labels]
    scores = [
        {r.doc_id: r.score for r in toxicity.toxicity(frame, spark.createDataFrame(x, "doc_id long, quality int, toxic int")).collect()}
        for x in (labels, flipped)
    ]
    assert scores[0] == scores[1]


def test_no_labels_and_no_documents(spark):
    frame = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [(r.score, r.predicted) for r in toxicity.toxicity(frame, labels).collect()] == [(0.0, 0)]
    assert toxicity.toxicity(frame.limit(0), labels).collect() == [] and toxicity.drop_toxic(frame, labels).count() == 1


def test_every_word_counts_and_learned_ones_more(spark):
    docs, labels, _ = corpus()
    # A text without any word that goes with the label still has neighbours, by its other words.
    toxic = next(i for i, _, y in labels if y and zlib.crc32(str(i).encode()) % 5)
    own = docs[toxic][1]
    edited = " ".join("zzz" if w in ("VILE!", "nasty", "grimlok", "grimsty", "grimz.") else w for w in own.split())
    docs += [(5_000, edited, "x", 0.5), (5_001, "unheard of words", "x", 0.5)]
    model, counted = toxicity.fit(
        spark.createDataFrame(docs, "doc_id long, text string, a string, b double"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )
    assert {"bamin$", "nasty$", "grim"} <= set(model.chosen) and "bami" not in model.chosen
    weight = dict(zip(model.chosen, model.weights, strict=True))
    assert weight["nasty$"] > 3 * weight["bamin$"] > 0
    rows = {r.doc_id: r for r in counted.where("doc_id >= 5000").collect()}
    assert len(rows[5_000].terms) >= 10 and rows[5_001].terms == []
    score, evidence = model.score(np.array(rows[5_000].terms), np.array(rows[5_000].counts))
    assert 0 < score < 1 and len(evidence) == 3
    assert model.score(np.zeros(0, np.int64), np.zeros(0, np.int64)) == (model.empty, [])


def test_held_out_recall_on_the_table(spark):
    sf_dir = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = [r for r in queries.op5_toxicity(spark, sf_dir).collect() if r.held_out and r.doc_id in truth]
    hits = sum(r.predicted and truth[r.doc_id] for r in rows)
    assert hits >= 0.9 * sum(truth[r.doc_id] for r in rows) and hits >= 0.95 * sum(r.predicted for r in rows)
