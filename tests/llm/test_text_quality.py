import random

import numpy as np
import pytest

from wattline.llm import quality


def test_em_finds_the_labellers_accuracies():
    rng = np.random.default_rng(1)
    truth = rng.random(40_000) < 0.7
    right = np.array([[0.9, 0.8], [0.75, 0.95], [0.7, 0.7], [0.85, 0.6], [0.8, 0.9]])  # of bad, of good rows
    correct = rng.random((len(truth), 5)) < right[:, truth.astype(int)].T
    votes = np.where(correct, truth[:, None], ~truth[:, None]).astype(int)
    votes[rng.random(votes.shape) < 0.2] = quality.NONE
    patterns, at, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    posterior, table, share = quality.estimate(patterns, counts.astype(float), wrongs=1.0)
    assert share == pytest.approx(0.7, abs=0.02)
    assert table[0, :, quality.BAD] == pytest.approx(right[:, 0], abs=0.03)
    assert table[1, :, quality.GOOD] == pytest.approx(right[:, 1], abs=0.03)
    assert ((posterior[at] >= 0.5) == truth).mean() > 0.9


def corpus():
    rng = random.Random(3)
    # As long as common words and many enough not to repeat all the time.
    parts = [a + b for a in "bdfgklmnprstv" for b in ("a", "e", "i", "on", "ur")]
    vocabulary = ["the", "of", *(a + b for a in parts for b in parts)]

    def prose(n):
        return " ".join(w + rng.choice(["", "", "", "", "", "", "", "", "", "", ",", "."]) for w in rng.choices(vocabulary, k=n)).capitalize() + "."

    rows, good = [], {}
    for i in range(500):
        n = rng.randint(30, 200)
        kind = i % 5
        good[i] = kind > 1
        text = prose(n)
        if kind == 0:
            text = " ".join(w + rng.choice(["###", "***", "&&&"]) for w in text.split())
        elif kind == 1:
            text = " ".join(w.upper() for w in text.split()[:10] for _ in range(8)) if i % 2 else " | ".join(text.split())
        rows.append((i, text, "x", 1.0))
    return rows, good


def test_scorer_agrees_with_the_truth_it_never_saw(spark):
    rows, good = corpus()
    rows += [(None, rows[2][1], "x", 1.0), (900, None, "x", 1.0), (901, "", "x", 1.0), (2, rows[2][1], "x", 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, words string, score double")
    got = quality.quality(df).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.kept == (r.predicted == 1) for r in got)
    right = [r.kept == good[r.doc_id] for r in got if r.doc_id in good]
    assert sum(right) >= 0.97 * len(right)
    empty = {r.score for r in got if r.doc_id in (900, 901)}
    assert len(empty) == 1 and empty.pop() < 0.5


def test_empty_table_and_one_class(spark):
    df = spark.createDataFrame([(1, "")], "doc_id long, text string")
    assert len(quality.quality(df).collect()) == 1 and quality.quality(df.limit(0)).collect() == []
