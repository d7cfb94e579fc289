"""SentencePiece by prefix table against the library."""

import hashlib
import random

import numpy as np
import pytest

sentencepiece = pytest.importorskip("sentencepiece")
P = pytest.importorskip("public_tokenizers")

from wattline.llm import pieces, queries
from wattline.llm.common import table

PATH = P.path("piece_bpe_32k.model")
SMALL = "/root/testdata/sf0.001"
ODD = [
    "", " ", "  ", "\n", "a", " a", "a ", "a  b", "   a", "▁a▁▁b", "a b", "\x00\x01\x7f", "x" * 4000, " " * 70 + "x" + " " * 15,
    "é é 日本語 한국 🙂🙂 ​", "<s> </s> <unk> <0x0A>", "\r\n);\r if (x) {\r", "a\tb\n  c", "…ﬁ½İı", "▁", "a" * 63 + " " + "b" * 65,
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def random_texts(own, n):
    rng = random.Random(11)
    parts = [p.replace("▁", " ") for p in own.ids]
    signs = list(" ▁\n\t abceinorst.,;:'\"(){}<>=0189éß漢の한🙂\x00\r/Th")
    return ["".join(rng.choices(rng.choice([parts, signs, [*signs, " " * 9]]), k=rng.randint(1, 40))) for _ in range(n)]


def test_ids_and_decoded_texts_equal_the_library(library):
    own = pieces.load(PATH)
    assert own.tabled
    forms = pieces.WordForms(own)
    for text in ODD + random_texts(own, 6000):
        ids = [own.begin, *library.encode(text), own.end]
        assert [own.begin, *own.encode(text), own.end] == ids, text
        assert own.decode(ids) == library.decode(ids), text
        n, packed, raw = forms.convert(text)
        assert (n, packed, raw) == (len(ids), np.array(ids, "<u4").tobytes(), library.decode(ids).encode()), text


def test_every_prefix_ends_in_its_own_token(library):
    own = pieces.load(PATH)
    for text in ["▁internationalisation", "▁wherethe", "▁日本語x", "▁aaaaaaaaaaaaaaa1234567"]:
        last = own.table(text)
        for end in range(1, len(text) + 1):
            ids = library.encode(text[1:end]) if end > 1 else [own.ids["▁"]]
            assert last[end] == ids[-1] or last[end] == pieces.UNKNOWN and ids[-1] in own.bytes_of.values()


def test_compatible_pairs_are_those_that_stay(library):
    own, rng = pieces.load(PATH), random.Random(2)
    plain = [i for t, i in own.ids.items() if i in own.left or len(t) == 1]
    seen = set()
    for a, b in zip(rng.choices(plain, k=4000), rng.choices(plain, k=4000), strict=True):
        if own.texts[b].startswith("▁") and own.texts[a] != "▁":
            continue
        # Without a mark in front of the text the library would add one.
        stays = pieces.merged(list(own.texts[a] + own.texts[b]), own.ranks) == [own.texts[a], own.texts[b]]
        assert own.compatible(a, b) == stays, (own.texts[a], own.texts[b])
        seen.add(stays)
    assert seen == {True, False}


def test_words_are_forgotten_without_harm(library, monkeypatch):
    monkeypatch.setattr(pieces, "MEMO_WORDS", 3)
    monkeypatch.setattr(pieces, "MEMO_PAIRS", 3)
    own = pieces.Pieces(PATH)
    forms = pieces.WordForms(own)
    assert own.memo.size == forms.memo.size == 3
    for text in ["one two three four five six", "one one two seven", "x y z " * 20]:
        assert own.encode(text) == library.encode(text)
        assert forms.convert(text)[0] == len(library.encode(text)) + 2


def test_a_vocabulary_without_the_properties_is_left_to_the_library(library):
    own = pieces.Pieces(PATH)
    own.tabled = False
    for text in ODD:
        ids = [own.begin, *library.encode(text), own.end]
        assert own.encode(text) == ids[1:-1] and own.decode(ids) == library.decode(ids)
        assert pieces.WordForms(own).convert(text)[0] == len(ids)


def digests_by_hand(library, text):
    ids = [1, *library.encode(text or ""), 2]
    sha = [hashlib.sha256(x).hexdigest() for x in (np.array(ids, "<u4").tobytes(), library.decode(ids).encode())]
    return (len(ids), *sha)


def test_frames(spark, library):
    values = [None, *ODD, "same", "same", "word another. " * 9000]
    rows = [(i // 2, v, "x", 1) for i, v in enumerate(values)] + [(None, "lost id", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, ids int")
    found = sorted(map(tuple, pieces.digests(docs, PATH).collect()), key=str)
    assert found == sorted(((r[0], *digests_by_hand(library, r[1])) for r in rows), key=str)
    full = pieces.encoded(docs, PATH).collect()
    assert sorted((str(r.doc_id), len(r.ids), r.n_tokens) for r in full) == sorted((str(r[0]), r[1], r[1]) for r in found)
    assert {r.decoded for r in full} == {(v or "").replace("▁", " ") for v in [r[1] for r in rows]}
    assert pieces.digests(docs.limit(0), PATH).collect() == []


def test_query_on_the_table(spark, library):
    docs = {r.doc_id: r.text for r in table(spark, SMALL, "documents").collect()}
    for r in queries.op12_sentencepiece(spark, SMALL).collect():
        assert tuple(r)[1:] == digests_by_hand(library, docs[r.doc_id])
