import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattline.llm import packing, queries


def padding(lengths, limits):
    return sum(min(x for x in limits if x >= n) - n for n in lengths)


@pytest.mark.parametrize("buckets", [1, 2, 3, 5])
def test_limits_pad_least(buckets):
    rng = random.Random(buckets)
    for _ in range(20):
        lengths = [rng.randint(0, 12) for _ in range(rng.randint(1, 40))]
        values, counts = np.unique(lengths, return_counts=True)
        limits = packing.best_limits(values.astype(float), counts.astype(float), buckets)
        choices = itertools.combinations(values[:-1].tolist(), min(buckets, len(values)) - 1)
        assert padding(lengths, limits) == min(padding(lengths, [*c, values[-1]]) for c in choices)


def test_every_document_once_in_batches_within_the_budget(spark, monkeypatch):
    monkeypatch.setattr(packing, "ROWS_NUMBERED", 50)
    rng = random.Random(1)
    texts = [None, "", " \n"] + ["w " * rng.choice([1, 5, 9, 40, 41, 300, 900]) for _ in range(700)] + ["x " * 30_000]
    rows = [(i if i != 9 else None, t, 7, "b") for i, t in enumerate(texts)] + [(5, texts[5], 7, "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int, bucket string")
    got = packing.pack(df, buckets=4, budget=2_000).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens) for r in got) == sorted(
        (i is None, i or 0, len((t or "").split())) for i, t, _, _ in rows
    )
    batches = {}
    for r in got:
        assert r.n_tokens <= r.padded_to and r.batch_limit == max(1, 2_000 // max(1, r.padded_to))
        batches.setdefault(r.bucket, {}).setdefault(r.batch_id, []).append(r.slot)
    for bucket, own in batches.items():
        limit = next(r.batch_limit for r in got if r.bucket == bucket)
        assert sorted(own) == list(range(len(own)))
        for batch, slots in own.items():
            full = limit if batch < len(own) - 1 else len(slots)
            assert sorted(slots) == list(range(full)) and full <= limit
    assert len(batches) == 4


def test_many_lengths_are_parted_as_by_trying_every_start():
    rng = np.random.default_rng(4)
    for b, buckets in ((1, 3), (2, 2), (300, 7), (301, 16)):
        lengths = np.unique(rng.integers(0, 40_000, b)).astype(float)
        counts = rng.integers(1, 50, len(lengths)).astype(float)
        n, s = (np.concatenate([[0], np.cumsum(x)]) for x in (counts, counts * lengths))
        cost = np.concatenate([[0.0], np.full(len(lengths), np.inf)])
        for _ in range(min(buckets, len(lengths))):
            new = np.full(len(cost), np.inf)
            for j in range(1, len(cost)):
                new[j] = (cost[:j] + lengths[j - 1] * (n[j] - n[:j]) - (s[j] - s[:j])).min()
            cost = new
        limits = np.array(packing.best_limits(lengths, counts, buckets))
        assert len(limits) == min(buckets, len(lengths)) and limits[-1] == lengths[-1]
        assert ((limits[np.searchsorted(limits, lengths)] - lengths) * counts).sum() == cost[-1]


def test_rows_without_an_id_spread_over_shards(spark, monkeypatch):
    monkeypatch.setattr(packing, "ROWS_NUMBERED", 10)
    df = spark.createDataFrame([(None, "a b c")] * 200, "doc_id long, text string")
    got = packing.pack(df, budget=9).collect()
    assert sorted((r.batch_id, r.slot) for r in got) == [(i // 3, i % 3) for i in range(200)]


def test_given_lengths_and_empty_table(spark):
    df = spark.createDataFrame([(i, 1 << i) for i in range(25)] + [(99, None)], "doc_id long, tokens long")
    got = {r.doc_id: r for r in packing.pack(df.withColumn("text", F.lit("x")), F.col("tokens"), buckets=30).collect()}
    assert got[24].n_tokens == got[24].padded_to == 1 << 24 and got[99].n_tokens == 0
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_registered_query_packs_tokens_not_words(spark, tmp_path):
    pytest.importorskip("tokenizers")
    pytest.importorskip("public_tokenizers")
    texts = ["日本語" * 500, "x9Q" * 3_000, "plain words here", "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    want = {r.doc_id: r.n_tokens for r in queries.op3_token_counts(spark, str(tmp_path)).collect()}
    got = {r.doc_id: r.n_tokens for r in queries.op7_packing(spark, str(tmp_path)).collect()}
    assert got == want and got[0] > 500 and got[1] > 1_000
