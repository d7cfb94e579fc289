import datetime as dt

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from checks import models
from checks.common import Tables
from tests.helpers import period
from wattline.operators import boosting, trees
from wattline.operators import quantiles as q
from wattline.operators.windows import row_index
from wattline.plans import training
from wattline.sources import models as store


@pytest.fixture(scope="module")
def panel(spark):
    rng = np.random.default_rng(0)
    rows = []
    for key, slope in ((1, 2.0), (2, -1.0)):
        for i in range(400):
            x = float(rng.normal(10, 3))
            rows.append((key, period(i), x, float(rng.normal()), slope * x + 5 + float(rng.normal(0, 2))))
    return spark.createDataFrame(rows, "k int, t timestamp, x double, z double, y double").cache()


def pinball_loss(residual, alpha):
    return np.mean(np.maximum(alpha * residual, (alpha - 1) * residual))


def best_loss(x, y, alpha):
    """The least attainable loss, by linear descent on ever sharper smoothings, independent of the estimator."""
    a = np.column_stack([np.ones(len(y)), x])
    beta = np.linalg.lstsq(a, y, rcond=None)[0]
    beta[0] += np.quantile(y - a @ beta, alpha)
    best, width = pinball_loss(y - a @ beta, alpha), np.median(np.abs(y - a @ beta))
    for width in width * 0.5 ** np.arange(12):
        for _ in range(40):
            z = np.clip((y - a @ beta) / width, -30, 30)
            p = 1 / (1 + np.exp(z))
            hessian = (a * (p * (1 - p) / width)[:, None]).T @ a + 1e-6 * np.eye(a.shape[1])
            step = np.linalg.solve(hessian, a.T @ (p - alpha))
            size = 1.0
            while size > 1e-4 and pinball_loss(y - a @ (beta - size * step), alpha) > best:
                size /= 2
            if size <= 1e-4:
                break
            beta = beta - size * step
            best = pinball_loss(y - a @ beta, alpha)
    return best


@pytest.mark.parametrize("errors", ["normal", "lognormal", "tied"])
def test_fit_reaches_the_quantiles_of_any_errors(spark, errors):
    rng = np.random.default_rng(11)
    noise = {"normal": rng.normal(0, 2, 3000), "lognormal": rng.lognormal(0, 1.5, 3000), "tied": np.round(rng.exponential(40, 3000))}
    x = rng.normal(size=(3000, 2))
    y = 5 + x @ [2.0, -1.0] + noise[errors]
    rows = [(period(i), float(a), float(b), float(v)) for i, ((a, b), v) in enumerate(zip(x, y))]
    indexed = q.indexed_rows(spark.createDataFrame(rows, "t timestamp, x double, z double, y double"), "y", ["x", "z"], "t", [])
    passed = q.fit(indexed, "y", ["x", "z"], n_splits=1, in_task=0).filter("fold = 1").collect()
    for r in q.fit(indexed, "y", ["x", "z"], n_splits=1).filter("fold = 1").collect() + passed:
        residual = y - np.column_stack([np.ones(3000), x]) @ np.array(r["coef"])
        assert r["converged"]
        assert pinball_loss(residual, r["alpha"]) <= 1.01 * best_loss(x, y, r["alpha"])
        assert abs((residual <= 0).mean() - r["alpha"]) <= 0.02


def test_tasks_and_passes_take_the_same_steps(panel):
    indexed = q.indexed_rows(panel, "y", ["x", "z"], "t", ["k"])
    found = [q.fit(indexed, "y", ["x", "z"], ["k"], n_splits=2, in_task=n).collect() for n in (400, 399)]
    one, other = ({(r["k"], r["fold"], r["alpha"]): r for r in rows} for rows in found)
    assert one.keys() == other.keys() and len(one) == 18
    for key, r in one.items():
        assert r["converged"] == other[key]["converged"] and r["coef"] == pytest.approx(other[key]["coef"], rel=1e-6)


def test_short_series_has_a_final_model(spark):
    rng = np.random.default_rng(2)
    rows = [(period(i), k, float(rng.normal()), float(i % 7)) for k, n in ((1, 400), (2, 50)) for i in range(n)]
    df = spark.createDataFrame(rows, "t timestamp, k int, y double, x double")
    models, _ = q.train_per_series(df, "y", ["x"], "t", ["k"])
    assert {(r["k"], r["fold"]) for r in models.collect()} == {(1, f) for f in range(6)} | {(2, 5)}
    mixed = q.fit(q.indexed_rows(df, "y", ["x"], "t", ["k"]), "y", ["x"], ["k"], in_task=100)
    assert {(r["k"], r["fold"]) for r in mixed.collect()} == {(1, f) for f in range(6)} | {(2, 5)}
    assert q.score(df, models, ["x"], ["k"]).count() == 450


def test_grouped_regression_equals_brute_force(panel):
    models, summary = q.train_per_series(panel, "y", ["x", "z"], "t", ["k"])
    pdf = panel.toPandas()
    final = models.filter("fold = 5").collect()
    assert len(final) == 6 and models.count() == 2 * 3 * 6
    for r in final:
        g = pdf[pdf.k == r["k"]]
        x, y = g[["x", "z"]].to_numpy(), g["y"].to_numpy()
        residual = y - np.column_stack([np.ones(len(y)), x]) @ np.array(r["coef"])
        assert pinball_loss(residual, r["alpha"]) <= 1.01 * best_loss(x, y, r["alpha"])
    losses = {(r["k"], r["alpha"]): r for r in summary.collect()}
    assert len(losses) == 6
    assert losses[(1, 0.5)]["pinball_loss"] == pytest.approx(losses[(1, 0.5)]["mae"] / 2)
    assert losses[(1, 0.5)]["mae"] < 2.2 and losses[(1, 0.1)]["pinball_loss"] < losses[(1, 0.5)]["pinball_loss"]


def test_scores_are_calibrated_and_unknown_series_left_out(panel):
    models, _ = q.train_per_series(panel, "y", ["x", "z"], "t", ["k"], n_splits=2)
    more = panel.unionByName(panel.limit(5).withColumn("k", F.lit(99)))
    scored = q.score(more, models, ["x", "z"], ["k"])
    assert scored.count() == 800
    inside = scored.select(F.avg(F.col("y").between(F.col("p10"), F.col("p90")).cast("int"))).first()[0]
    assert 0.75 < inside < 0.85


def test_importance_finds_the_used_feature(panel):
    one = panel.filter("k = 1")
    rows = trees.with_vector(one, ["x", "z"]).withColumn("_label", F.col("y"))
    model = LinearRegression(labelCol="_label").fit(rows)
    got = trees.permutation_importance(row_index(one, "t"), model, "y", ["x", "z"]).collect()
    assert [r["feature"] for r in got] == ["x", "z"] and got[0]["importance"] > 1 and abs(got[1]["importance"]) < 0.2


def test_mixture_finds_the_planted_centres(spark):
    rng = np.random.default_rng(1)
    centres = [(0, 0), (5, -5), (10, 3)]
    data = [tuple(float(v) for v in rng.normal(c, 0.5)) for c in centres for _ in range(170)]
    df = spark.createDataFrame(data, "a double, b double")
    model, aic, bic = trees.session_mixture(df, ["a", "b"], k=3)
    found = sorted(tuple(r["mean"].toArray()) for r in model.gaussiansDF.collect())
    assert np.abs(np.array(found) - np.array(centres)).max() < 0.2
    assert np.abs(np.array(model.weights) - 1 / 3).max() < 0.02 and bic > aic
    n, log_likelihood = trees.mixture_likelihood(df, ["a", "b"], model).first()
    free = 2 + 3 * 2 + 3 * 3
    assert n == 510 and aic == pytest.approx(2 * free - 2 * log_likelihood, rel=1e-3)
    assert bic == pytest.approx(free * np.log(510) - 2 * log_likelihood, rel=1e-3)


def recorded(monkeypatch, module, name, seen, result):
    def record(*args, **rest):
        seen.update(args=args, rest=rest)
        raise result

    monkeypatch.setattr(module, name, record)


class Reached(Exception):
    pass


def test_registered_quantile_trees_are_not_cut(spark, monkeypatch):
    seen = {}
    recorded(monkeypatch, models.training, "train_trees", seen, Reached())
    with pytest.raises(Reached):
        models.train_quantiles(Tables(spark, "/root/testdata/sf0.01"))
    indexed, target, features = seen["args"][:3]
    assert seen["rest"] == {} and target == "carbon_intensity" and len(seen["args"]) == 6
    assert set(indexed.columns) - set(features) == {"settlement_period", "carbon_intensity", "row_no", "series_rows"}
    wanted = {"carbon_intensity_lag_2", "carbon_intensity_lag_336", "season_sin", "is_bank_holiday_uk", "london_temperature"}
    assert wanted <= set(features)
    shape = boosting.Model("p50", 0)
    assert (shape.rounds, shape.rate, shape.depth) == (300, 0.05, 5)


def test_registered_comparison_is_not_cut(spark, monkeypatch):
    seen = {}
    recorded(monkeypatch, models.boosting, "compare_models", seen, Reached())
    with pytest.raises(Reached):
        models.compare_models(Tables(spark, "/root/testdata/sf0.01"))
    assert seen["args"][1:] == ("carbon_intensity", models.LAG_FEATURES) and seen["rest"] == {}
    chosen = boosting.learners()
    assert max(boosting.FOREST_SIZES) == 750 == chosen["random_forest"].rounds and chosen["boosting_1000"].rounds == 1000


def test_store_reads_the_newest_complete_day(spark, panel, tmp_path):
    base, keys = str(tmp_path / "store"), ["k"]
    fitted, _ = q.train_per_series(panel, "y", ["x", "z"], "t", keys, alphas=[0.5], n_splits=2)
    fitted = fitted.withColumn("features", F.array(F.lit("x"), F.lit("z")))
    with pytest.raises(FileNotFoundError):
        store.load_latest_models(spark, base, "plain")
    store.save_models(fitted.limit(1), base, "plain", dt.date(2024, 1, 1), keys)
    store.save_models(fitted.filter("k = 1"), base, "plain", dt.date(2024, 1, 2), keys)
    store.save_models(fitted, base, "other", dt.date(2024, 1, 9), keys)
    # Half a day: models without a manifest, then a manifest that was not finished.
    half = f"{base}/variant=plain/model_date=2024-01-03"
    fitted.write.parquet(f"{half}/models-x")
    (tmp_path / "store/variant=plain/model_date=2024-01-03/manifest-000000-x").mkdir()
    last = store.load_latest_models(spark, base, "plain")
    assert {(r["k"], str(r["model_date"]), r["variant"]) for r in last.collect()} == {(1, "2024-01-02", "plain")}
    scored, unknown = training.score_stored_series(panel, base, "plain", keys, [0.5])
    assert scored.count() == 400 and [tuple(r) for r in unknown.collect()] == [(2, 400)]
    # A second run on the day replaces the first; one that lost rows is an error.
    store.save_models(fitted, base, "plain", dt.date(2024, 1, 2), keys)
    assert store.load_latest_models(spark, base, "plain").count() == 6
    folder = store.manifests(spark, base, "plain")[0]["folder"]
    fitted.limit(2).write.mode("overwrite").parquet(f"{base}/variant=plain/model_date=2024-01-02/{folder}")
    with pytest.raises(ValueError, match="manifest"):
        store.load_latest_models(spark, base, "plain")


def test_training_stores_scores_and_logs(spark, panel, tmp_path):
    base, log = str(tmp_path / "models"), str(tmp_path / "log")
    indexed = row_index(panel.filter("k = 1"), "t")
    predicted, losses = training.train_trees(indexed, "y", ["x", "z"], base, "v", dt.date(2024, 1, 1), log, n_splits=2, rounds=5, rate=0.5)
    training.train_series(panel, "y", ["x", "z"], "t", ["k"], base, "s", dt.date(2024, 1, 1), log, n_splits=2)
    runs = {r["run"]: r for r in store.read_run_log(spark, log).collect()}
    assert set(runs) == {f"{n}_alpha_{a}" for n in ("v_trees", "s_series") for a in (0.1, 0.5, 0.9)}
    one = runs["v_trees_alpha_0.5"]
    assert one["params"]["n_estimators"] == "5" and one["params"]["training_rows"] == "400"
    assert one["metrics"]["oof_pinball_loss"] == {r["alpha"]: r["pinball_loss"] for r in losses.collect()}[0.5]
    scored = training.score_stored_trees(indexed, base, "v")
    assert scored.count() == 400 and {"p10", "p50", "p90"} <= set(scored.columns)
    with pytest.raises(ValueError, match="lack p99"):
        training.score_stored_trees(indexed, base, "v", ["p50", "p99"])
