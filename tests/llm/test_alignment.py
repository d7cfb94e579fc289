"""Cross-tokenizer alignment against the libraries' encodings of whole texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
P = pytest.importorskip("public_tokenizers")

from wattline.llm import alignment, queries, token_counts
from wattline.llm.common import table

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
SMALL = "/root/testdata/sf0.001"
ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "\n", "a\n b", "a \n", "▁", "a ▁b", "x▁ y", "<|endoftext|> a<|endoftext|>", "don't we'll",
    "é 日本語 한국 🙂🙂", "\x00 \x1c a\x85 b", "tab\tand\r\n);\r", "x" * 900, " " * 50 + "x", "a" * 63 + " " + "b" * 65, "same text", "same text",
]


@pytest.fixture(scope="module")
def libraries():
    a = tokenizers.Tokenizer.from_file(A)
    a.encode_special_tokens = True
    symbols = token_counts.byte_of_symbol()
    b = sentencepiece.SentencePieceProcessor(model_file=B)

    def a_tokens(text):
        encoded = a.encode(text, add_special_tokens=False)
        return [(i, bytes(symbols[c] for c in t)) for i, t in zip(encoded.ids, encoded.tokens, strict=True)]

    def b_tokens(text):
        ids = b.encode(text)
        return [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in ids]

    return a_tokens, b_tokens


def ranges(tokens):
    at, out = 0, []
    for i, raw in tokens:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def by_hand(texts, libraries):
    """All rows without doc_id, and the counts of pairs."""
    a_tokens, b_tokens = libraries
    linked, counts = [], Counter()
    for text in texts:
        a, b = (a_tokens(" " + text), b_tokens(text)) if text else ([], [])
        whole = (" " + (text or "")).encode()
        if b"".join(r for _, r in a) != whole or b"".join(r for _, r in b) != whole:
            linked.append(None)
            continue
        a, b = ranges(a), ranges(b)
        links = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]
        counts.update(links)
        linked.append((a, b, links))
    highest = Counter()
    for (_, j), n in counts.items():
        highest[j] = max(highest[j], n)
    rows = []
    for own in linked:
        if own is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, links = own
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, low = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, s, e in side if low <= s and e <= cut) for side in (a, b)))
            low = cut
        best = sum(counts[p] == highest[p[1]] for p in links)
        rows.append((len(a), len(b), len(groups), len(links), best, sum(counts[p] for p in links), ";".join(groups)))
    return rows, counts


def texts(n=60):
    rng = random.Random(4)
    parts = ["the", "er", "ing ", " ", "  ", "\n", ". ", "'s", " 9", "é", "tion", "!!", "<|endoftext|>", "\t", "日本", "▁", " wh", "Ele"]
    weights = [9] * 15 + [1] * 3
    return ODD + ["".join(rng.choices(parts, weights, k=rng.randint(1, 60))) for _ in range(n)]


def frame(spark, values):
    rows = [(None if i == 3 else i // 2, v, "x", 1) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "doc_id long, text string, block string, keys int")


@pytest.mark.parametrize("sizes", [{}, {"block": 40, "shard": 50, "fan": 2}])
def test_equals_the_libraries(spark, libraries, sizes):
    values = texts()
    rows, counts = by_hand(values, libraries)
    docs = frame(spark, values)
    full, pairs = alignment.aligned(docs, A, B, full=True, **sizes)
    ids = [None if i == 3 else i // 2 for i in range(len(values))]
    assert sorted(map(tuple, full.collect()), key=str) == sorted(((i, *r) for i, r in zip(ids, rows, strict=True)), key=str)
    assert {(r.a_id, r.b_id): r.n for r in pairs.collect()} == counts
    hashed, _ = alignment.aligned(docs, A, B, **sizes)
    shown = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[0] else "") for r in rows]
    assert sorted(map(tuple, hashed.collect()), key=str) == sorted(((i, *r) for i, r in zip(ids, shown, strict=True)), key=str)


def test_whole_texts_equal_words(monkeypatch):
    monkeypatch.setattr(alignment, "MEMO_WORDS", 50)
    words, whole = alignment.Aligner(A, B), alignment.Aligner(A, B)
    assert words.cuts
    whole.cuts = False
    for text in filter(None, texts(200)):
        one, other = words.align(text), whole.align(text)
        assert (one is None) == (other is None)
        if one:
            assert one.groups() == other.groups() and (one.links() == other.links()).all()
            assert (len(one.a), len(one.b), len(one.common)) == (len(other.a), len(other.b), len(other.common))


def test_links_are_counted_in_parts(spark, libraries, monkeypatch):
    monkeypatch.setattr(alignment, "LINKS", 3)
    values = texts(5)
    _, counts = by_hand(values, libraries)
    _, pairs = alignment.aligned(frame(spark, values), A, B)
    assert {(r.a_id, r.b_id): r.n for r in pairs.collect()} == counts


@pytest.mark.parametrize("n", [0, 1, 2, 100, 20_000])
def test_minimal_perfect_hash(n, monkeypatch):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 40, n))
    for levels in (48, 1):
        monkeypatch.setattr(alignment, "LEVELS", levels)
        hashed = alignment.PerfectHash.read(alignment.PerfectHash.build(keys).write())
        assert sorted(hashed.place(keys).tolist()) == list(range(len(keys)))
        hashed.place(keys + (1 << 41))  # strange keys get some place, or none


def test_strange_key_is_an_error():
    keys = np.array([5, 6, 7], np.int64)
    shard = alignment._hash(alignment.pa.table({"shard": [0], "keys": alignment.pa.array([keys.tobytes()], alignment.pa.binary())}))
    find, n = alignment._places(shard)
    assert n == 3 and sorted(find(keys)) == [0, 1, 2]
    with pytest.raises(ValueError):
        find(np.array([8], np.int64))


def test_nothing_to_align(spark):
    for values in ([], [None, "", "▁"]):
        docs, pairs = alignment.aligned(frame(spark, values), A, B)
        assert [tuple(r)[1:] for r in docs.collect()] == [(0, 0, 0, 0, 0, 0, "")] * len(values)
        assert pairs.collect() == []


def test_query_on_the_table(spark, libraries):
    docs = table(spark, SMALL, "documents").select("doc_id", "text").collect()
    docs = [d for d in docs]
    a_tokens, b_tokens = libraries
    # Tokens, groups and links of every document; counts by the pairs of all.
    found = {r.doc_id: r for r in queries.op11_alignment(spark, SMALL).collect()}
    assert len(found) == len(docs)
    counts, links = Counter(), {}
    for d in docs:
        a, b = ranges(a_tokens(" " + d.text)), ranges(b_tokens(d.text))
        own, i, j = [], 0, 0
        while i < len(a) and j < len(b):
            own.append((a[i][0], b[j][0]))
            e, f = a[i][2], b[j][2]
            i, j = i + (e <= f), j + (f <= e)
        links[d.doc_id] = (len(a), len(b), len({e for *_, e in a} & {e for *_, e in b}), own)
        counts.update(own)
    highest = Counter()
    for (_, j), n in counts.items():
        highest[j] = max(highest[j], n)
    for i, (n_a, n_b, n_groups, own) in links.items():
        r = found[i]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links) == (n_a, n_b, n_groups, len(own))
        assert r.n_best == sum(counts[p] == highest[p[1]] for p in own) and r.count_sum == sum(counts[p] for p in own)


def test_a_block_aligns_each_word_once(monkeypatch):
    tokens, plain = [], alignment.Aligned.__init__

    def counting(self, aligner, a, b):
        tokens.append(len(a))
        plain(self, aligner, a, b)

    class Task:
        get = classmethod(lambda cls: cls)
        partitionId = staticmethod(lambda: 0)

    monkeypatch.setattr(alignment.Aligned, "__init__", counting)
    monkeypatch.setattr(alignment, "TaskContext", Task)
    pa, text = alignment.pa, "some words some more words"
    once = len(alignment.Aligner(A, B).a.encode(" some words more", add_special_tokens=False).ids)
    batch = pa.record_batch([pa.array(range(50), pa.int64()), pa.array([text] * 49 + ["lost ▁mark"])], names=["doc_id", "text"])
    rows = pa.Table.from_batches(list(alignment._blocks(A, B, 1 << 20, pa.int64())(iter([batch]))))
    assert sum(tokens) == once
    assert rows.column("words").null_count == 2  # of the lossy text, and of the block's own row
    links = np.concatenate([alignment.longs(x.as_py()) for x in rows.column("counts") if x.is_valid])
    assert links.sum() == 49 * len(alignment.Aligner(A, B).align(text).links())
