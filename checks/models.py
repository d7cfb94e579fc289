"""Models. Fitted numbers have no SQL form, so queries return what must hold of them: rows of each fold, sums over
them, and whether losses, shares, sums and stored copies agree when worked out a second way."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from checks import charging as charging_checks
from checks import features as feature_checks
from checks.common import Tables, sql
from wattline.functions.reference import ALPHAS
from wattline.operators import attribution, boosting, evaluate, quantiles, trees
from wattline.operators import charging as ch
from wattline.operators.windows import row_index
from wattline.plans import medallion, national, training
from wattline.session import settled, work_path
from wattline.sources import models as store

TS, TARGET, KEYS = "settlement_period", "carbon_intensity", ["region_id"]
LAG_FEATURES = ["lag_1", "lag_2", "lag_48", "lag_336", "rolling_avg_7day"]
WEATHER_FEATURES = [*LAG_FEATURES, "temperature", "wind_speed", "radiation", "temp_roll_avg_7day"]


def _dense_gold(t: Tables):
    """Features of every region and slot: long enough for five folds with a gap of a day."""
    return medallion.gold_carbon(t.dense_regional.select("region_id", F.col("slot").alias(TS), TARGET))


def _gold(t: Tables):
    return medallion.training_rows(_dense_gold(t))


def _gold_weather(t: Tables):
    gold = _dense_gold(t)
    both = medallion.gold_carbon_weather(gold, medallion.silver_weather(t.regional_weather))
    return medallion.training_rows(both)


def _losses_by_hand(predicted, keys):
    """Per key and quantile: test rows, their sum, and the loss from predictions, by the definition."""
    each = F.array(*[F.struct(F.lit(a).alias("alpha"), F.col(f"p{round(100 * a)}").alias("p")) for a in ALPHAS])
    long = predicted.select(*keys, F.col(TARGET).cast("double").alias("y"), F.inline(each))
    miss = F.col("y") - F.col("p")
    loss = F.when(miss >= 0, miss * F.col("alpha")).otherwise(miss * (F.col("alpha") - 1))
    return long.groupBy(*keys, "alpha").agg(
        F.count("p").alias("n_rows"), F.sum("y").cast("long").alias("y_total"), F.avg(loss).alias("by_hand"),
        F.avg((F.col("y") < F.col("p")).cast("int")).alias("below"),
    )


def _train_series(t: Tables, gold, features):
    """Per region and quantile: rows tested, their sum, and whether the summary's loss is that of the predictions."""
    indexed = settled(quantiles.indexed_rows(gold, TARGET, features, TS, KEYS))
    models, summary = quantiles.train_per_series(gold, TARGET, features, TS, KEYS)
    tested = quantiles.out_of_fold(indexed, models, features, KEYS)
    both = _losses_by_hand(tested, KEYS).join(summary, [*KEYS, "alpha"])
    # A quantile of unseen rows may stray; that of the rows a model was fitted on only as far as tied residuals go.
    final = _losses_by_hand(quantiles.score(indexed, models, features, KEYS), KEYS).select(*KEYS, "alpha", F.col("below").alias("share"))
    return both.join(final, [*KEYS, "alpha"]).select(
        *KEYS, "alpha", "n_rows", "y_total", (F.abs(F.col("pinball_loss") - F.col("by_hand")) < 1e-9).alias("loss_agrees"),
        (F.abs(F.col("share") - F.col("alpha")) < 0.1).alias("share_fits"),
    )


def train_regional(t: Tables):
    return _train_series(t, _gold(t), LAG_FEATURES)


def train_regional_weather(t: Tables):
    return _train_series(t, _gold_weather(t), WEATHER_FEATURES)


def score_regional(t: Tables):
    """Models with weather, trained without region 14 and stored, read back and applied to every row: per region the
    rows scored, their sum, whether there was a model, and whether decision errors are those of the definition."""
    gold = settled(_gold_weather(t))
    base = work_path(t.spark, "models")
    known = gold.filter("region_id < 14")
    training.train_series(known, TARGET, WEATHER_FEATURES, TS, KEYS, base, "with_weather", dt.date(2024, 2, 1), alphas=[0.5])
    scored, unknown = training.score_stored_series(gold, base, "with_weather", KEYS, [0.5])
    scored = settled(scored)
    quality = evaluate.decision_quality(scored, TARGET, "p50", KEYS)
    mae = scored.groupBy(*KEYS).agg(
        F.count("p50").alias("n_rows"), F.sum(TARGET).cast("long").alias("y_total"), F.avg(F.abs(F.col(TARGET) - F.col("p50"))).alias("by_hand")
    )
    found = mae.join(quality, KEYS).select(
        *KEYS, "n_rows", "y_total", F.lit(True).alias("has_model"), (F.abs(F.col("mae_gco2") - F.col("by_hand")) < 1e-6).alias("error_agrees")
    )
    none = unknown.select(*KEYS, "n_rows", F.lit(0).cast("long").alias("y_total"), F.lit(False).alias("has_model"), F.lit(False).alias("error_agrees"))
    return found.unionByName(none)


def _national(t: Tables):
    """Indexed national features, weather included, and their names."""
    table = settled(national.national_features(t.carbon, t.generation, t.weather, entities=feature_checks.CITY_NAMES))
    return row_index(table, TS), [c for c in table.columns if c not in (TS, TARGET)]


def train_quantiles(t: Tables):
    """Boosted quantile trees on all national features: 5 folds, 300 trees, 3 quantiles and the final models. Per fold
    and quantile the rows tested, their sum, and whether stored models give the same losses and fitted shares."""
    indexed, names = _national(t)
    indexed = settled(indexed)
    if indexed.isEmpty():
        return t.spark.createDataFrame([], "fold long, alpha double, n_rows long, y_total long, loss_agrees boolean, share_fits boolean")
    base = work_path(t.spark, "models")
    predicted, losses = training.train_trees(indexed, TARGET, names, base, "national", dt.date(2024, 2, 1))
    total = _losses_by_hand(predicted, []).join(losses, "alpha").select("alpha", (F.abs(F.col("by_hand") - F.col("pinball_loss")) < 1e-9).alias("loss_agrees"))
    stored = training.score_stored_trees(indexed, base, "national")
    share = _losses_by_hand(stored, []).select("alpha", (F.abs(F.col("below") - F.col("alpha")) < 0.05).alias("share_fits"))
    by_fold = _losses_by_hand(predicted, ["fold"]).select("fold", "alpha", "n_rows", "y_total")
    return by_fold.join(total, "alpha").join(share, "alpha")


def compare_models(t: Tables):
    """All default learners on five folds: rows tested, and what holds of every loss."""
    indexed = settled(row_index(_gold(t), TS, KEYS))
    found = boosting.compare_models(indexed, TARGET, LAG_FEATURES)
    tested = evaluate.fold_members(indexed).filter("role = 'test'")
    n, low, high = tested.agg(F.count(F.lit(1)), F.min(TARGET), F.max(TARGET)).first()
    return found.select(
        "model", F.lit(n).alias("n_rows"), (F.abs(F.col("mae") - 2 * F.col("pinball_loss")) < 1e-9).alias("mae_is_twice_loss"),
        F.col("mae").between(0, high - low).alias("error_in_range"),
    )


def importance(t: Tables):
    """Mean absolute attributions of the median model on all national features: per feature the rows, and whether the
    attributions of every row add up to its prediction."""
    indexed, names = _national(t)
    indexed = settled(indexed)
    if indexed.isEmpty():
        return t.spark.createDataFrame([], "feature string, n_rows long, mean_abs_bounds_mean boolean, adds_up boolean")
    base = work_path(t.spark, "models")
    models, _ = boosting.train_quantiles(indexed, TARGET, names, alphas=[0.5])
    store.save_models(models.filter("fold = 5"), base, "national", dt.date(2024, 2, 1))
    last = store.load_latest_models(t.spark, base, "national", ["p50"])
    rows = settled(attribution.attribute(indexed, last, names, "p50", [TS]))
    total = F.aggregate("attributions", F.lit(0.0), lambda a, x: a + x)
    n, off = rows.agg(F.count(F.lit(1)), F.max(F.abs(total - (F.col("prediction") - F.col("base"))))).first()
    return attribution.mean_attribution(rows, names).select(
        "feature", F.lit(n).alias("n_rows"), (F.col("mean_abs") >= F.abs("mean") - 1e-9).alias("mean_abs_bounds_mean"),
        F.lit(off < 1e-6).alias("adds_up"),
    )


def model_store(t: Tables):
    """Two variants over three days, one rerun and one broken off: what a reader finds of each, and every region's
    number of models."""
    gold = settled(_gold(t))
    base = work_path(t.spark, "models")
    models, _ = quantiles.train_per_series(gold, TARGET, LAG_FEATURES, TS, KEYS, alphas=[0.5])
    models = settled(models)
    first, second, third = (dt.date(2024, 3, d) for d in (1, 2, 3))
    store.save_models(models.filter("region_id = 1"), base, "no_weather", second, KEYS)
    store.save_models(models, base, "no_weather", second, KEYS)
    store.save_models(models.filter("region_id <= 7"), base, "with_weather", first, KEYS)
    # The third day was broken off before its manifest.
    models.filter("region_id = 2").write.parquet(f"{base}/variant=no_weather/model_date={third}/models-broken")
    found = [
        store.load_latest_models(t.spark, base, v).groupBy("variant", F.col("model_date").cast("string").alias("model_date"), *KEYS)
        .agg(F.count(F.lit(1)).alias("n_models"), F.max(F.size("coef")).alias("n_coefficients"))
        for v in ("no_weather", "with_weather")
    ]
    return found[0].unionByName(found[1])


def run_log(t: Tables):
    """The log that both trainers leave: a row for each quantile, with its parameters."""
    log, base = work_path(t.spark, "runs"), work_path(t.spark, "models")
    gold = settled(_gold(t))
    training.train_series(gold, TARGET, LAG_FEATURES, TS, KEYS, base, "no_weather", dt.date(2024, 2, 1), log)
    one = settled(row_index(gold.filter("region_id = 1"), TS))
    training.train_trees(one, TARGET, LAG_FEATURES, base, "region_1", dt.date(2024, 2, 1), log, rounds=20)
    runs = store.read_run_log(t.spark, log)
    return runs.select(
        "run", F.col("params")["alpha"].cast("double").alias("alpha"), F.col("params")["n_splits"].cast("long").alias("n_splits"),
        F.col("params")["training_rows"].cast("long").alias("training_rows"), F.col("params")["n_estimators"].cast("long").alias("n_estimators"),
        (F.col("metrics")["oof_pinball_loss"] > 0).alias("has_loss"),
    )


def session_mixture(t: Tables):
    """Five components over valid sessions: what must hold of weights and criteria, and the criteria worked out again
    from the densities of all sessions."""
    columns = ["arrival_hour", "duration_hours", "energy_kwh", "day_of_week"]
    features = settled(ch.valid_sessions(ch.session_features(t.sessions)))
    model, aic, bic = trees.session_mixture(features, columns)
    n, log_likelihood = trees.mixture_likelihood(features, columns, model).first()
    free = 4 + 5 * 4 + 5 * 10
    ok = [
        abs(sum(model.weights) - 1) < 1e-9 and min(model.weights) > 0,
        abs(aic - (2 * free - 2 * log_likelihood)) < 1e-3 * abs(aic) + 1,
        bic > aic,
    ]
    rows = [(i, int(n), *ok) for i in range(len(model.weights))]
    return t.spark.createDataFrame(rows, "component int, n_sessions long, weights_fit boolean, aic_agrees boolean, bic_above_aic boolean")


# ---- SQL ------------------------------------------------------------------------------------

_FOLDS = """SELECT *, (n - (5 * (n // 6))) AS first_test, n // 6 AS size FROM (SELECT *, row_number() OVER ({part} ORDER BY
    settlement_period) - 1 AS row_no, count(*) OVER ({part_only}) AS n FROM ({rows}))"""


def _tested(rows: str, key: str = "") -> str:
    part = f"PARTITION BY {key}" if key else ""
    inner = _FOLDS.format(part=part, part_only=part, rows=rows)
    return f"""SELECT *, (row_no - first_test) // size AS fold FROM ({inner}) WHERE row_no >= first_test
        AND size >= 1 AND n - 48 - 5 * size > 0"""


_ALPHAS = "(SELECT unnest([0.1e0, 0.5e0, 0.9e0]) AS alpha)"
_DENSE_GOLD = """SELECT * FROM (SELECT region_id, slot AS settlement_period, carbon_intensity, """ + ", ".join(
    f"lag(carbon_intensity, {n}) OVER (PARTITION BY region_id ORDER BY slot) AS lag_{n}" for n in (1, 2, 48, 336)
) + """ FROM dense) WHERE lag_1 IS NOT NULL AND lag_2 IS NOT NULL AND lag_48 IS NOT NULL AND lag_336 IS NOT NULL"""
_DENSE_WEATHER = f"""SELECT g.* FROM ({_DENSE_GOLD}) g JOIN half_hourly h ON h.region_id = g.region_id
    AND h.timestamp = g.settlement_period"""
_FULL_WEATHER = f"""{_DENSE_WEATHER} WHERE h.temperature IS NOT NULL AND h.wind_speed IS NOT NULL AND h.radiation IS NOT NULL"""


def _series_sql(needs: str, rows: str) -> str:
    return sql(
        needs,
        f"""SELECT region_id, alpha, count(*) AS n_rows, CAST(sum(carbon_intensity) AS BIGINT) AS y_total, TRUE AS loss_agrees,
        TRUE AS share_fits FROM ({_tested(rows, 'region_id')}), {_ALPHAS} GROUP BY 1, 2""",
    )


_FEATURES = feature_checks.QUERIES["national_features"][1]
_MODELS = "decision_tree_free decision_tree_5 random_forest_25 random_forest_50 random_forest_125 random_forest_250 " \
    "random_forest_500 random_forest_750 boosting_100 boosting_1000 boosting_1000_wide"
SQL = {
    "train_regional": _series_sql("dense", _DENSE_GOLD),
    "train_regional_weather": _series_sql("dense half_hourly", _FULL_WEATHER),
    "score_regional": sql(
        "dense half_hourly",
        f"""SELECT region_id, count(*) AS n_rows, CASE WHEN region_id < 14 THEN CAST(sum(carbon_intensity) AS BIGINT) ELSE 0 END
        AS y_total, region_id < 14 AS has_model, region_id < 14 AS error_agrees FROM ({_DENSE_WEATHER}) GROUP BY 1""",
    ),
    "train_quantiles": f"""SELECT fold, alpha, count(*) AS n_rows, CAST(sum(carbon_intensity) AS BIGINT) AS y_total, TRUE AS loss_agrees,
        TRUE AS share_fits FROM ({_tested(_FEATURES)}), {_ALPHAS} GROUP BY 1, 2""",
    "compare_models": sql(
        "dense",
        f"""SELECT unnest(string_split('{_MODELS}', ' ')) AS model, n_rows, TRUE AS mae_is_twice_loss, TRUE AS error_in_range
        FROM (SELECT count(*) AS n_rows FROM ({_tested(_DENSE_GOLD, 'region_id')}))""",
    ),
    "importance": f"""SELECT column_name AS feature, (SELECT count(*) FROM ({_FEATURES})) AS n_rows, TRUE AS mean_abs_bounds_mean,
        TRUE AS adds_up FROM (DESCRIBE {_FEATURES}) WHERE column_name NOT IN ('settlement_period', 'carbon_intensity') AND n_rows > 0""",
    "model_store": sql(
        "dense",
        f"""SELECT 'no_weather' AS variant, '2024-03-02' AS model_date, region_id, 6 AS n_models, 6 AS n_coefficients
        FROM ({_DENSE_GOLD}) GROUP BY region_id
        UNION ALL SELECT 'with_weather', '2024-03-01', region_id, 6, 6 FROM ({_DENSE_GOLD}) WHERE region_id <= 7 GROUP BY region_id""",
    ),
    "run_log": sql(
        "dense",
        f"""SELECT concat('no_weather_series_alpha_', alpha) AS run, alpha, 5 AS n_splits, (SELECT count(*) FROM ({_DENSE_GOLD}))
        AS training_rows, NULL AS n_estimators, TRUE AS has_loss FROM {_ALPHAS}
        UNION ALL SELECT concat('region_1_trees_alpha_', alpha), alpha, 5, (SELECT count(*) FROM ({_DENSE_GOLD})
        WHERE region_id = 1), 20, TRUE FROM {_ALPHAS}""",
    ),
    "session_mixture": f"""SELECT unnest(range(5)) AS component, n AS n_sessions, TRUE AS weights_fit, TRUE AS aic_agrees,
        TRUE AS bic_above_aic FROM (SELECT count(*) AS n FROM ({charging_checks.QUERIES['session_filter'][1]}))""",
}
_BUILT = [
    train_regional, train_regional_weather, score_regional, train_quantiles, compare_models, importance, model_store, run_log, session_mixture,
]
QUERIES = {q.__name__: (q, SQL[q.__name__]) for q in _BUILT}
