import hashlib
import random

import pytest

from wattline.llm import substrings


def brute(rows, length):
    """(n_words, removed places) for each row, by the definition."""
    words = [(t or "").encode().split() for _, t in rows]
    smallest = {}
    for (i, _), w in zip(rows, words):
        if i is not None:
            for s in range(len(w) - length + 1):
                key = tuple(w[s : s + length])
                smallest[key] = min(smallest.get(key, i), i)
    found = []
    for (i, _), w in zip(rows, words):
        gone = set()
        for s in range(len(w) - length + 1):
            if i is not None and smallest[tuple(w[s : s + length])] < i:
                gone |= set(range(s, s + length))
        found.append((w, gone))
    return found


def corpus(seed, length):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "Ünï", "a,b"]
    passages = [rng.choices(vocabulary, k=rng.randint(length // 2, 3 * length)) for _ in range(12)]
    rows = []
    for _ in range(90):
        parts = []
        for _ in range(rng.randint(0, 5)):
            parts += rng.choice(passages) if rng.random() < 0.5 else rng.choices(vocabulary, k=rng.randint(1, 2 * length))
        if parts and rng.random() < 0.3:
            parts[rng.randrange(len(parts))] = "changed"
        rows.append((rng.randrange(10_000), rng.choice([" ", "\n", " \t"]).join(parts)))
    loop = ("round and round " * length).strip()
    rows += [(None, rows[0][1]), (20_000, None), (20_001, ""), (5, loop), (20_002, "x " + loop), (20_003, "same " * 4 * length)]
    rows += [(20_004, "same " * 3 * length), (rows[3][0], rows[3][1]), (rows[4][0], rows[5][1])]
    return rows


@pytest.mark.parametrize("length, gram", [(50, 20), (12, 5), (6, 6)])
def test_removal_equals_brute_force(spark, length, gram):
    rows = corpus(length, length)
    df = spark.createDataFrame([(i, t, 0, "s") for i, t in rows], "doc_id long, text string, at int, a string")
    got = sorted((r.doc_id or -1, r.n_words, r.n_removed, r.kept_sha256) for r in substrings.repeats(df, length, gram).collect())
    want = []
    for (i, _), (words, gone) in zip(rows, brute(rows, length)):
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        want.append((i or -1, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    assert got == sorted(want)


def test_stage_cuts_passages_and_leaves_the_rest(spark):
    rng = random.Random(2)
    own = [" ".join(f"d{d}w{rng.randrange(10**6)}" for _ in range(40)) for d in range(6)]
    passage = " ".join(f"p{i}" for i in range(70))
    rows = [(d, f"{own[d]}\n{passage}\n{own[d][:30].strip()}" if d % 2 else own[d] + "  end", d) for d in range(6)]
    rows += [(8, None, 1), (None, passage, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int")
    got = {r.doc_id: r for r in substrings.drop_repeats(docs).collect()}
    assert substrings.drop_repeats(docs).schema.names == docs.schema.names
    assert got[0].text == rows[0][1] and got[1].text == rows[1][1] and got[8].text is None and got[None].text == passage
    for d in (3, 5):
        assert got[d].text == f"{own[d]} {own[d][:30].strip()}" and got[d].n_chars == len(got[d].text)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.repeats(none).collect() == [] and substrings.drop_repeats(none).collect() == []
