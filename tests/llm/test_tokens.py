import hashlib
import random

import pytest

tokenizers = pytest.importorskip("tokenizers")
P = pytest.importorskip("public_tokenizers")

from wattline.llm import bpe, token_counts

BYTES, WORDS = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")
ODD = [
    None, "", " ", "\n", "a  b", "a\n b", " x", "x ", "a\tb \n c", "don't we'll 'tis '", "\x1c a", "a\x85 b", "a b   c",
    "<|endoftext|>", "a  <|endoftext|> b<|startoftext|>", "<|endoftext", "x" * 5000, "é ́ ́a É İ Σας", "日本 語 😀 x😀",
    "A.B,C!! d## 12a3 a_b [x] {y} <z>", "same words here", "same words here",
]


def texts():
    rng = random.Random(3)
    syllables = ["the", "er", "ing", " ", "  ", "\n", ".", "'s", "'re", "9", "é", "tion", "!!", "<|endoftext|>", "\t"]
    return ODD + ["".join(rng.choices(syllables, k=rng.randint(1, 120))) for _ in range(150)]


def frame(spark, values):
    rows = [(i, v, "x", 1) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, row int")


def library(path, text):
    return tokenizers.Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("chunk, overlap", [(32_768, 1_024), (150, 100)])
def test_counts_equal_the_library(spark, chunk, overlap):
    values = texts() + ["word another. " * 3000, "a " * 2000 + "b" * 3000 + " c" * 500, " " * 900 + "x" + "\n" * 700]
    got = {r.doc_id: r for r in token_counts.token_counts(frame(spark, values), BYTES, 20, chunk, overlap).collect()}
    assert len(got) == len(values)
    tokenizer = tokenizers.Tokenizer.from_file(BYTES)
    for i, v in enumerate(values):
        n = len(tokenizer.encode(v or "", add_special_tokens=False))
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((v or "").encode()), n > 20), v


def test_rows_without_or_with_the_same_id_are_answered(spark):
    df = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b"), (1, "c " * 400)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_tokens) for r in token_counts.token_counts(df, BYTES, chunk=200, overlap=100).collect())
    assert got == [(0, 2), (1, 2), (1, 2), (1, len(library(BYTES, "c " * 400)))]
    assert bpe.digests(df, WORDS).count() == 4


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.token_counts(none, BYTES).collect() == []
    assert bpe.digests(none, WORDS).collect() == []


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_round_trip_equals_the_library(spark, path):
    values = texts()
    tokenizer = tokenizers.Tokenizer.from_file(path)
    digests = {r.doc_id: r for r in bpe.digests(frame(spark, values), path).collect()}
    whole = {r.doc_id: r for r in bpe.encoded(frame(spark, values), path).collect()}
    for i, v in enumerate(values):
        ids = tokenizer.encode(v or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        assert (whole[i].ids, whole[i].decoded) == (ids, decoded), v
        want = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), decoded)]
        assert [digests[i].n_tokens, digests[i].ids_sha256, digests[i].decoded_sha256] == [len(ids), *want], v


def test_forced_boundaries_come_from_the_vocabulary():
    codec = bpe.Codec(WORDS)
    assert codec.splits and not bpe.Codec(BYTES).splits
    assert codec.fragments(b"abc.def12") == [b"abc", b".", b"def", b"1", b"2"]
    assert codec.fragments(b"don't") == [b"don't"]


def test_places_of_a_chunk_are_those_of_its_whole_encoding():
    counter = token_counts.WordCounts(BYTES)
    rng = random.Random(6)
    cut = 0
    for text in [*texts()[len(ODD):], *(" ".join(map(str, rng.choices(ODD[5:], k=40))) for _ in range(30)), "x" * 400, " " * 300 + "\n" * 99]:
        for overlap in (70, 90):
            if len(text) <= 2 * overlap:
                continue
            cut += token_counts.safe_ends(text, overlap) != (0, 0)
            encoding = counter.tokenizer.encode(text, add_special_tokens=False)
            every = token_counts.piece_starts(encoding)
            left, right, n = token_counts.chunk_places(counter, text, overlap)
            assert n == len(encoding)
            assert left == [p for p in every if p[0] < overlap]
            assert right == [p for p in every if len(text) - overlap <= p[0] <= len(text) - token_counts.MARGIN]
    assert cut > 50
