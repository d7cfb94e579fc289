import numpy as np
import pytest

from wattline.llm import neighbours


def brute(rows, k=20, every=20):
    good = [(i, np.array(v, dtype=np.float64)) for i, v in rows if i is not None and v is not None and None not in v]
    good = [(i, v) for i, v in good if np.isfinite(v).all() and v.any()]
    return {
        i: sorted((-float((v * q).sum()), j) for j, v in good if j != i)[:k] for i, q in good if i % every == 0
    }


def answers(spark, rows, **how):
    df = spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id long, embedding array<float>, rank int, score double")
    found = {}
    for r in neighbours.nearest(df, **how).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((-r.score, r.vec_id))
        assert r.rank == len(found[r.query_id])
    return found


def recall(got, want):
    return sum(len({j for _, j in got[q]} & {j for _, j in want[q]}) for q in want) / sum(map(len, want.values()))


@pytest.mark.parametrize("spread", [0.0, 1.0])
def test_recall_against_brute_force(spark, monkeypatch, spread):
    monkeypatch.setattr(neighbours, "BLOCK", 700)
    monkeypatch.setattr(neighbours, "ASKED", 60)
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((20, 32)) * spread
    x = (centres[rng.integers(0, 20, 3000)] + rng.standard_normal((3000, 32))) * rng.uniform(0.5, 2, (3000, 1))
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    got, want = answers(spark, rows), brute(rows)
    assert got.keys() == want.keys() and all(len(got[q]) == 20 for q in want)
    assert recall(got, want) >= 0.95
    for q in want:
        scores = dict((j, s) for s, j in got[q])
        assert all(scores[j] == pytest.approx(s, abs=1e-12) for s, j in want[q] if j in scores)


def test_odd_rows_and_ties(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(8).astype(np.float32).tolist()) for i in range(30)]
    rows += [(i, rows[7][1]) for i in range(100, 150)]  # many copies of one vector
    rows += [(200, None), (201, [0.0] * 8), (202, [1.0] * 7 + [None]), (203, [1.0] * 7 + [float("nan")])]
    rows += [(204, [float("inf")] * 8), (None, rows[0][1]), (141, rows[3][1])]
    assert answers(spark, rows) == {q: [(pytest.approx(s), j) for s, j in v] for q, v in brute(rows).items()}
    assert len(answers(spark, rows[:5])[0]) == 4
    assert answers(spark, rows[:1]) == {} and answers(spark, [(3, None)]) == {}


def test_index_returns_every_code_within_the_radius():
    rng = np.random.default_rng(6)
    codes = rng.integers(0, 256, (400, 6), dtype=np.uint8)
    for radius in (5, 14, 20):
        index = neighbours.MultiIndex(codes, radius)
        for code in codes[:30]:
            assert index.within(code).tolist() == np.flatnonzero(neighbours.distances(codes, code) <= radius).tolist()


def test_rows_that_share_an_id_fill_one_place_each(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.standard_normal(6).astype(np.float32).tolist()) for i in range(60)]
    rows += [(20, rows[21][1]), (20, rows[20][1]), (33, rows[33][1])]
    found = answers(spark, rows, k=10)[20]
    mine = [np.array(v, dtype=np.float64) for i, v in rows if i == 20]
    want = sorted((-max(float((np.array(v, dtype=np.float64) * q).sum()) for q in mine), j) for j, v in rows if j != 20)[:10]
    assert found == [(pytest.approx(s), j) for s, j in want]


def test_a_small_radius_costs_no_answers(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "learned_radius", lambda *rest: 0)
    rng = np.random.default_rng(9)
    rows = [(i, rng.standard_normal(8).astype(np.float32).tolist()) for i in range(200)]
    assert answers(spark, rows) == {q: [(pytest.approx(s), j) for s, j in v] for q, v in brute(rows).items()}


def test_vectors_of_two_lengths_raise(spark):
    with pytest.raises(ValueError, match="components"):
        answers(spark, [(0, [1.0, 2.0]), (1, [1.0]), (2, [2.0, 2.0])])
    assert answers(spark, []) == {}
