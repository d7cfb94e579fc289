"""Trees of many models at once: both ways of growing, folds, forests by prefix, attributions."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.helpers import period
from wattline.operators import attribution, boosting
from wattline.operators.evaluate import fold_members
from wattline.operators.windows import row_index

NAMES = ["x", "z", "c"]


@pytest.fixture(scope="module")
def indexed(spark):
    rng = np.random.default_rng(0)
    rows = []
    for key, slope in ((1, 2.0), (2, -1.0)):
        for i in range(420):
            x, z = float(rng.normal(10, 3)), float(rng.normal())
            y = slope * x + 5 + 3 * (z > 0) + float(rng.normal(0, 1 + (x > 10)))
            rows.append((key, period(i), x, None if i % 11 == 0 else z, float(key), y if i % 50 else None))
    df = spark.createDataFrame(rows, "k int, t timestamp, x double, z double, c double, y double")
    return row_index(df, "t", ["k"]).cache()


def loss(rows, alpha, column):
    residual = np.array([r["y"] - r[column] for r in rows])
    return np.mean(np.maximum(alpha * residual, (alpha - 1) * residual))


def test_folds_are_those_of_fold_members(indexed):
    marked = boosting.fold_columns(indexed, 4, 20).collect()
    wanted = {(r["k"], r["row_no"], r["fold"]): r["role"] for r in fold_members(indexed, 4, 20).collect()}
    for r in marked:
        for fold in range(4):
            role = "test" if r["_test_fold"] == fold else "train" if r["_train_from"] <= fold else None
            assert wanted.get((r["k"], r["row_no"], fold)) == role
    with pytest.raises(Exception, match="too short"):
        boosting.fold_columns(indexed.filter("row_no < 3").withColumn("series_rows", F.lit(3)), 4, 20).collect()


def test_trees_of_one_task_equal_those_of_many_jobs(indexed):
    growth = {"rounds": 12, "rate": 0.3, "depth": 3}
    here, predicted = boosting.train_quantiles(indexed, "y", NAMES, n_splits=2, **growth)
    there, spread = boosting.train_quantiles(indexed, "y", NAMES, n_splits=2, local_rows=0, **growth)
    names = ["fold", "name", "feature", "bin", "threshold", "left", "right", "value", "cover", "start", "base"]
    one, other = (sorted(map(tuple, m.select(*names).collect()), key=lambda r: r[:2]) for m in (here, there))
    assert one == other and len(one) == 9
    key = lambda r: (r["k"], r["row_no"])
    for a, b in zip(sorted(predicted.collect(), key=key), sorted(spread.collect(), key=key), strict=True):
        assert (a["fold"], a["p10"], a["p90"]) == (b["fold"], pytest.approx(b["p10"], rel=1e-9), pytest.approx(b["p90"], rel=1e-9))


def test_quantiles_of_unseen_rows(indexed):
    models, predicted = boosting.train_quantiles(indexed, "y", NAMES, n_splits=2, rounds=60, rate=0.1)
    rows = predicted.collect()
    labelled = indexed.filter("y IS NOT NULL")
    assert len(rows) == fold_members(labelled, 2).filter("role = 'test'").count() == len({(r["k"], r["row_no"]) for r in rows})
    for name, alpha in (("p10", 0.1), ("p50", 0.5), ("p90", 0.9)):
        assert abs(np.mean([r["y"] <= r[name] for r in rows]) - alpha) < 0.12
    constant = np.quantile([r["y"] for r in rows], 0.5)
    assert loss(rows, 0.5, "p50") < 0.25 * np.mean(np.abs([r["y"] - constant for r in rows])) / 2 + 0.3
    final = models.filter("fold = 2")
    scored = attribution.score(labelled, final, NAMES).collect()
    assert abs(np.mean([r["y"] <= r["p90"] for r in scored]) - 0.9) < 0.03
    assert scored[0].asDict().keys() == {*labelled.columns, "p10", "p50", "p90"}
    # A test row's prediction is that of its fold's model.
    first = attribution.score(labelled, models.filter("fold = 0"), NAMES, ["p50"])
    own = {(r["k"], r["row_no"]): r["p50"] for r in first.collect()}
    assert all(own[r["k"], r["row_no"]] == pytest.approx(r["p50"], rel=1e-9) for r in rows if r["fold"] == 0)


def test_best_split_equals_trying_all():
    rng = np.random.default_rng(3)
    for objective, alpha in (("squared", 0.5), ("quantile", 0.2)):
        model = boosting.Model("m", 0, objective, alpha, min_rows=4)
        for _ in range(20):
            bins, node = rng.integers(0, 6, (60, 3)).astype(np.uint8), rng.integers(0, 3, 60)
            y, fit, weight = rng.normal(size=60), rng.normal(size=60) * 0.3, np.ones(60)
            gradient = boosting.gradients(model, y, fit)
            found = boosting.best_splits(*boosting.histogram(bins, node, weight, gradient), 3, model)
            target = y - fit if objective == "squared" else np.where(y < fit, alpha - 1, alpha)
            for k in range(3):
                best, own = 1e-9, None
                for f in range(3):
                    for b in range(6):
                        inside = node == k
                        left, right = inside & (bins[:, f] <= b), inside & (bins[:, f] > b)
                        if min(left.sum(), right.sum()) >= 4:
                            gain = sum(target[s].sum() ** 2 / s.sum() for s in (left, right)) - target[inside].sum() ** 2 / inside.sum()
                            if gain > best * (1 + 1e-9):
                                best, own = gain, (k, f, b)
                hits = [tuple(int(x[i]) for x in found) for i in range(len(found[0])) if found[0][i] == k]
                assert hits == ([own] if own else [])


def test_sparse_histogram_equals_dense():
    rng = np.random.default_rng(1)
    bins, node = rng.integers(0, 256, (50, 2)).astype(np.uint8), rng.integers(0, 4000, 50)
    node[0], weight, gradient = 3999, rng.integers(0, 3, 50).astype(float), rng.normal(size=50)
    cell, w, g = boosting.histogram(bins, node, weight, gradient)
    assert (np.diff(cell) > 0).all()
    for f in range(2):
        for i in range(50):
            at = (node[i] * 2 + f) * boosting.BINS + bins[i, f]
            same = (node == node[i]) & (bins[:, f] == bins[i, f])
            k = np.searchsorted(cell, at)
            if weight[same].sum():
                assert cell[k] == at and w[k] == pytest.approx(weight[same].sum()) and g[k] == pytest.approx((weight * gradient)[same].sum())


def test_bootstrap_draws_rows_as_a_poisson_variable_would():
    drawn = boosting.bootstrap(np.arange(200_000), 3, 42)
    assert abs(drawn.mean() - 1) < 0.01 and abs((drawn == 0).mean() - np.exp(-1)) < 0.005 and abs(drawn.var() - 1) < 0.02
    assert (drawn[100:200] == boosting.bootstrap(np.arange(100, 200), 3, 42)).all()
    assert (drawn != boosting.bootstrap(np.arange(200_000), 4, 42)).any()


def test_smaller_forests_are_prefixes(indexed):
    rows = indexed.filter("k = 1")
    chosen = boosting.learners((2, 4, 6), forest_depth=4, rounds=(3, 6))
    assert list(chosen) == ["decision_tree_free", "decision_tree_5", "random_forest", "boosting_3", "boosting_6", "boosting_6_wide"]
    both = [
        boosting.compare_models(rows, "y", NAMES, chosen, sizes=(2, 4, 6), n_splits=2, local_rows=n).collect() for n in (10_000, 0)
    ]
    assert {r["model"] for r in both[0]} == {*chosen, "random_forest_2", "random_forest_4", "random_forest_6"} - {"random_forest"}
    losses = [{r["model"]: r["pinball_loss"] for r in rows} for rows in both]
    assert losses[0] == pytest.approx(losses[1], rel=1e-6)
    assert all(r["mae"] == pytest.approx(2 * r["pinball_loss"]) for r in both[0])
    # A forest of two grown alone has the losses of the prefix.
    alone = boosting.compare_models(rows, "y", NAMES, {"f": boosting.learners((2,), 4)["random_forest"]}, sizes=(2,), n_splits=2)
    assert alone.collect()[0]["pinball_loss"] == pytest.approx(losses[0]["random_forest_2"])
    assert losses[0]["boosting_6"] < losses[0]["boosting_3"]


def shapley(model, x):
    """By the definition, over all subsets of features."""
    n = x.shape[0]

    def value(known, tree):
        def walk(node):
            if model["left"][node] < 0:
                return model["rate"] * model["value"][node]
            f, left, right = model["feature"][node], model["left"][node], model["right"][node]
            if f in known:
                return walk(left if np.isnan(x[f]) or x[f] <= model["threshold"][node] else right)
            return (model["cover"][left] * walk(left) + model["cover"][right] * walk(right)) / model["cover"][node]

        return walk(model["start"][tree])

    out = np.zeros(n)
    for tree in range(len(model["start"])):
        for f in range(n):
            others = [j for j in range(n) if j != f]
            for size in range(n):
                for known in combinations(others, size):
                    weight = factorial(size) * factorial(n - size - 1) / factorial(n)
                    out[f] += weight * (value({*known, f}, tree) - value(set(known), tree))
    return out


def test_attributions_equal_the_definition_and_add_up(indexed):
    models, _ = boosting.train_quantiles(indexed, "y", NAMES, n_splits=2, rounds=8, depth=3)
    final = models.filter("fold = 2")
    rows = attribution.attribute(indexed, final, NAMES, "p50", ["k", "row_no", "x", "z", "c"]).collect()
    assert len(rows) == indexed.count()
    model = attribution.collected(final.filter("name = 'p50'"), ["base", "rate"])[0]
    for r in rows:
        assert sum(r["attributions"]) == pytest.approx(r["prediction"] - r["base"], abs=1e-9)
    for r in rows[::40]:
        x = np.array([np.nan if r[c] is None else r[c] for c in NAMES])
        assert r["attributions"] == pytest.approx(shapley(model, x), abs=1e-9)
    ranked = attribution.mean_attribution(attribution.attribute(indexed, final, NAMES), NAMES).collect()
    assert [r["feature"] for r in ranked][:1] != ["z"] and len(ranked) == 3
    by_hand = np.abs([r["attributions"] for r in rows]).mean(axis=0)
    assert {r["feature"]: r["mean_abs"] for r in ranked} == pytest.approx(dict(zip(NAMES, by_hand, strict=True)))


def test_scoring_names_what_is_missing(indexed):
    models, _ = boosting.train_quantiles(indexed, "y", NAMES, alphas=[0.5], n_splits=2, rounds=1)
    with pytest.raises(ValueError, match="p10"):
        attribution.score(indexed, models.filter("fold = 2"), NAMES)
    with pytest.raises(ValueError):
        attribution.attribute(indexed, models, NAMES)
