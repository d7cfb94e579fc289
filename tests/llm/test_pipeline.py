import random
import re

import pytest

tokenizers = pytest.importorskip("tokenizers")
P = pytest.importorskip("public_tokenizers")

import corpus_pipeline
from wattline.llm import toxicity

WORDS = [f"{a}{b}{c}" for a in ("ba", "ke", "lo", "mi") for b in ("su", "te", "ra", "vo") for c in ("n", "rak", "l", "s", "mo", "d")]


def corpus():
    rng = random.Random(12)
    rows, labels, toxic = [], [], set()
    passage = " ".join(rng.choices(WORDS, k=80))
    for i in range(260):
        words = rng.choices(WORDS, k=rng.randint(60, 160))
        if rng.random() < 0.15:
            words[rng.randrange(len(words))] = rng.choice(["grimlok", "grimsty", "vileness"])
            toxic.add(i)
        if i % 3:
            labels.append((i, 1, int(i in toxic)))
        rows.append([i, " ".join(words)])
    clean = [r for r in rows if r[0] not in toxic]
    for n, (_, text) in enumerate(rng.sample(clean, 40)):
        words = text.split()
        if n % 2:
            words[rng.randrange(len(words))] = "edited"
            rows.append([1000 + n, " ".join(words)])
        else:
            rows.append([1000 + n, text.replace(" ", "  ", 3)])
    for n, (_, text) in enumerate(rng.sample(clean, 12)):
        rows.append([2000 + n, " ".join(rng.choices(WORDS, k=40)) + "\n" + passage + "\n" + " ".join(rng.choices(WORDS, k=30))])
    rows += [[3000, None], [3001, ""], [None, "no id here"]]
    return [(i, t, "en", "s", len(t or "")) for i, t in rows], labels


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_stages(docs):
    """Exact, near and substring stages over [(doc_id, text)], by definition."""
    first = {}
    for i, t in docs:
        key = re.sub(r"\s+", " ", t or "")
        if i is not None:
            first[key] = min(first.get(key, i), i)
    exact = [(i, t) for i, t in docs if i is None or first[re.sub(r"\s+", " ", t or "")] == i]
    sets = {i: shingles(t) for i, t in exact if i is not None}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    near = [(i, t) for i, t in exact if i is None or find(i) == i]
    starts = {}
    words = {i: (t or "").split() for i, t in near}
    for i, w in words.items():
        if i is not None:
            for s in range(len(w) - 49):
                key = tuple(w[s : s + 50])
                starts[key] = min(starts.get(key, i), i)
    cut = {}
    for i, w in words.items():
        gone = set()
        for s in range(len(w) - 49):
            if i is not None and starts[tuple(w[s : s + 50])] < i:
                gone |= set(range(s, s + 50))
        cut[i] = [x for k, x in enumerate(w) if k not in gone]
    return exact, near, cut


def test_stages_equal_brute_force(spark, tmp_path):
    rows, labels = corpus()
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, columns)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    known = spark.read.parquet(str(tmp_path / "labels.parquet"))
    scores = toxicity.toxicity(docs, known).collect()
    clean = {r.doc_id for r in scores if not r.predicted}
    kept = [(i, t) for i, t, *_ in rows if i in clean]
    exact, near, cut = brute_stages(kept)
    want = [kept, exact, near, list(cut.items())]
    current = docs
    for (name, stage), expected in zip(corpus_pipeline.STAGES[:-1], want, strict=True):
        current = stage(spark, current, str(tmp_path))
        assert current.columns == docs.columns, name
        current = spark.createDataFrame(current.collect(), current.schema)
        assert sorted(r.doc_id or -1 for r in current.collect()) == sorted(i or -1 for i, _ in expected), name
    assert {r.doc_id: (r.text or "").split() for r in current.collect()} == cut
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    tokenizer = tokenizers.Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    left = {r.doc_id: r.text or "" for r in current.collect()}
    n_tokens = {i: len(tokenizer.encode(t, add_special_tokens=False)) for i, t in left.items()}
    assert {r.doc_id: r.n_tokens for r in packed} == n_tokens and len(packed) == len(left)
    assert all(r.n_tokens <= r.padded_to for r in packed)
    assert sum(len(w) for w in cut.values()) < sum(len(t.split()) for _, t in near if t)


def written(spark, path, docs, labels=()):
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_empty_table(spark, tmp_path):
    path = written(spark, tmp_path, spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long"))
    assert corpus_pipeline.run(spark, path).collect() == []


def test_clashing_columns_and_repeated_rows(spark, tmp_path):
    names = ["n", "id", "tok", "row", "_salt", "root", "size", "at", "keep_id", "score", "lead"]
    schema = "doc_id long, text string, " + ", ".join(f"{c} string" for c in names)
    one, other = " ".join(WORDS[:60]), " ".join(WORDS[30:90])
    rows = [(i, t, *names) for i, t in ((1, one), (1, one), (2, one + " end"), (3, other), (4, None), (None, other))]
    path = written(spark, tmp_path, spark.createDataFrame(rows, schema))
    current = spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        current = stage(spark, current, path)
        assert current.columns == ["doc_id", "text", *names], name
        assert all(tuple(r)[2:] == tuple(names) for r in current.collect()), name
    assert {r.doc_id for r in corpus_pipeline.run(spark, path).collect()} == {1, 3, 4}  # without an id: a copy of 3
