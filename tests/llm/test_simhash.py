import random

import numpy as np
import pytest
import xxhash

from wattline.llm import simhash
from wattline.llm.graph import components


def brute_roots(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def brute_print(text, k=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


def corpus(seed=5):
    rng = random.Random(seed)
    vocabulary = [f"w{i}É" if i % 7 == 0 else f"W{i}" for i in range(400)]
    texts = [None, "", " \n", "one", "ONE", "one two three", "same same same same same same"]
    for _ in range(40):
        base = rng.choices(vocabulary, k=rng.randint(60, 300))
        texts.append(" ".join(base))
        texts += [" \t".join(edited(rng, base, rng.randint(1, 3))) for _ in range(rng.randint(0, 4))]
    base = rng.choices(vocabulary, k=250)
    texts += [" ".join(edited(rng, base, 2)) for _ in range(60)]  # one large group
    return texts + texts[10:14]


@pytest.mark.parametrize("home", [8_192, 20])
def test_groups_equal_brute_force(spark, monkeypatch, home):
    monkeypatch.setattr(simhash.links, "__defaults__", (0.0, home, 3 * home))
    texts = corpus()
    rows = [(i, t, 1, "a") for i, t in enumerate(texts)]
    got = simhash.near_groups(spark.createDataFrame(rows, "doc_id long, text string, fp int, root string")).collect()
    prints = [brute_print(t) for t in texts]
    edges = [(i, j) for i in range(len(texts)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    want = brute_roots(range(len(texts)), edges)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {i: (f"{prints[i]:016x}", want[i]) for i in want}


@pytest.mark.parametrize("words, radius, ratio", [(1, 4, 0.0), (1, 12, 0.0), (2, 20, 0.8), (4, 54, 0.8)])
def test_links_connect_what_all_pairs_connect(spark, words, radius, ratio):
    rng = np.random.default_rng(words)
    centres = rng.integers(0, 2**63, (60, words), dtype=np.uint64)
    points = centres[rng.integers(0, 60, 900)].copy()
    for p in points:
        for b in rng.integers(0, 64 * words, rng.integers(0, radius // 2 + 1)):
            p[b // 64] ^= np.uint64(1) << np.uint64(b % 64)
    sizes = rng.integers(50, 200, len(points))
    keys = sorted({(p.astype(">u8").tobytes(), int(s) if ratio else 0) for p, s in zip(points, sizes, strict=True)})
    df = spark.createDataFrame([(bytearray(k), s) for k, s in keys], "fp binary, size int").repartition(5)
    found = simhash.links(df, radius, ratio, home=100, queries=150).collect()
    fps, size = simhash.as_words([k for k, _ in keys]), np.array([s for _, s in keys])
    d = simhash.distances(fps, fps)
    good = (d <= radius) & (np.minimum(size[:, None], size) >= ratio * np.maximum(size[:, None], size))
    at = {k: i for i, k in enumerate(keys)}
    links = [(at[bytes(r.a), r.size_a], at[bytes(r.b), r.size_b]) for r in found]
    assert all(good[a, b] for a, b in links)
    assert brute_roots(range(len(keys)), links) == brute_roots(range(len(keys)), list(zip(*np.nonzero(good))))


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(1)
    path = list(range(100, 160))
    rng.shuffle(path)
    edges = list(zip(path, path[1:])) + [(5, i) for i in range(1000, 4000)] + [(7, 7), (None, 3), (1, 2), (2, 1)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    clean = [e for e in edges if None not in e and e[0] != e[1]]
    assert got == brute_roots({n for e in clean for n in e}, clean)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_stage_keeps_one_of_each_group(spark):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, families = [], {}
    for family in range(25):
        base = rng.choices(vocabulary, k=rng.randint(120, 400))
        for copy in range(rng.randint(1, 5)):
            words = edited(rng, base, len(base) // 100) if copy else base
            families[len(rows)] = family
            rows.append((len(rows), " ".join(words), "x"))
    first = {f: min(i for i in families if families[i] == f) for f in families.values()}
    extra = [(None, rows[0][1], "x"), (900, "", "x"), (901, None, "x"), (902, "short text", "x")]
    docs = spark.createDataFrame(rows + extra, "doc_id long, text string, fp string")
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    # Texts without words have equal fingerprints, but no shingle in common to be similar by: both empty.
    assert [i for none, i in ids if not none] == sorted([*first.values(), 900, 902]) and ids[-1][0]


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_groups(none).collect() == [] and simhash.drop_near_copies(none).collect() == []


def brute_kept(texts, k=5, similarity=0.8):
    sets = []
    for text in texts:
        w = text.lower().split()
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    edges = [
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j])
    ]
    root = brute_roots(range(len(sets)), edges)
    return sorted({root[i] for i in root})


def test_stage_equals_brute_force_on_families_near_the_threshold(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(4000)]
    texts, shares = [], []
    for family in range(40):
        base = rng.choices(vocabulary, k=260)
        texts += [" ".join(edited(rng, base, rng.choice([2, 3, 4, 5]))) for _ in range(8)]
    template = rng.choices(vocabulary, k=200)  # one line that all pages of a kind hold
    texts += [" ".join(template + rng.choices(vocabulary, k=rng.randint(30, 60))) for _ in range(80)]
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    for i in range(len(texts)):
        shares += [len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for j in range(i)]
    assert sum(0.75 <= s < 0.8 for s in shares) > 50 and sum(0.8 <= s < 0.85 for s in shares) > 50
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.drop_near_copies(docs).collect()) == brute_kept(texts)


def test_stage_links_near_fingerprints_by_the_tree(spark, monkeypatch):
    rng = random.Random(21)
    vocabulary = [f"w{i}" for i in range(4000)]
    texts = ["", " ", "one text", "One  text"]
    for _ in range(30):
        base = rng.choices(vocabulary, k=300)
        texts += [" ".join(edited(rng, base, n)) for n in (0, 0, 1, 2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    prints = [brute_print(t) for t in texts]
    near = [(i, j) for i in range(len(texts)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    root = brute_roots(range(len(texts)), near)
    assert 40 < len(texts) - len(set(root.values())) and any(prints[i] != prints[j] for i, j in near)
    pairs = [(r.a, r.b) for r in simhash._close_pairs(docs).collect()]
    assert brute_roots(range(len(texts)), pairs) == root and len(pairs) == len(texts) - len(set(root.values()))
    # Without the prefix join the stage still has these links, and only these.
    prefixes = simhash._prefixes
    monkeypatch.setattr(simhash, "_prefixes", lambda *a: prefixes(*a).where("false"))
    assert sorted(r.doc_id for r in simhash.drop_near_copies(docs).collect()) == sorted(set(root.values()))


def test_stage_checks_near_fingerprints_on_shingles(spark):
    rng = random.Random(22)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(900)], k=40)) for _ in range(12)]
    # Of a line that is repeated, fingerprints see the line alone; sets see all that differs.
    line = " ".join(f"l{i}" for i in range(7))
    texts += [" ".join([line] * 40 + [f"t{i}x{j}" for j in range(12)]) for i in range(5)]
    prints = [brute_print(t) for t in texts]
    assert sum((prints[i] ^ prints[j]).bit_count() <= 4 for i in range(12, 17) for j in range(12, i)) > 0
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.drop_near_copies(docs).collect()) == brute_kept(texts) == list(range(17))


def test_stage_finds_repeated_lines_and_short_copies(spark):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(4000)]
    texts = []
    for times in (10, 40, 60):
        base, line = rng.choices(vocabulary, k=200), rng.choices(vocabulary, k=8)
        texts += [" ".join(base + line), " ".join(base + line * times)]
    for _ in range(30):
        words = rng.choices(vocabulary, k=9)
        texts += [" ".join(words[:8]), " ".join(words)]  # 4 of 5 shingles in common
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = brute_kept(texts)
    assert want == list(range(0, len(texts), 2))
    assert sorted(r.doc_id for r in simhash.drop_near_copies(docs).collect()) == want


def test_sketches_differ_in_no_more_bits_than_sets_in_hashes():
    rng = np.random.default_rng(8)
    for n in (0, 1, 2, 31, 32, 33, 100, 511, 513, 4000):
        for gone, new in ((0, 0), (1, 0), (n // 10, n // 10), (n // 2, n), (n, 3 * n)):
            a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
            b = np.unique(np.concatenate([a[gone:], rng.integers(0, 2**64, new, dtype=np.uint64)]))
            s, t = simhash.sketch(a.view(np.int64)), simhash.sketch(b)
            assert simhash.sketches_differ(s, t) == simhash.sketches_differ(t, s) <= len(np.setxor1d(a, b))
            assert 16 * n <= 64 * len(s) <= max(32 * n, 512)


def test_stage_fetches_no_texts_of_pairs_that_are_far_apart(spark, monkeypatch):
    rng = random.Random(31)
    vocabulary = [f"w{i}" for i in range(6000)]
    texts = []
    for _ in range(6):  # pages of a kind have half of their shingles in common, far from 0.8
        template = rng.choices(vocabulary, k=200)
        texts += [" ".join(template + rng.choices(vocabulary, k=rng.randint(70, 80))) for _ in range(30)]
    texts += [" ".join(edited(rng, t.split(), 2)) for t in texts[::30]]
    compared, stored = [], simhash.stored

    def noted(df, name, *more):
        table = stored(df, name, *more)
        if name == "near-texts":
            compared.append(table.count())
        return table

    monkeypatch.setattr(simhash, "stored", noted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.drop_near_copies(docs).collect()) == brute_kept(texts) == list(range(180))
    assert 0 < sum(compared) < 40
