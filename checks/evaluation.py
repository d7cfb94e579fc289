"""Losses, baselines, folds, decision quality. Lags stand in for predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import Tables, r, sql
from wattline.operators import aggregates, evaluate
from wattline.operators.windows import add_windows
from wattline.plans import medallion
from wattline.session import work_path
from wattline.sources import files

ALPHA_OF = {"lag_2": 0.1, "lag_1": 0.5, "lag_48": 0.9}
ALPHA_COLUMNS = {"alpha_10": 0.1, "alpha_50": 0.5, "alpha_90": 0.9}


def _scored(t: Tables):
    return medallion.training_rows(medallion.gold_carbon(t.regional))


def _losses(t: Tables):
    return evaluate.pinball_by_alpha(_scored(t), "carbon_intensity", ALPHA_OF, ["region_id"])


def persistence(t: Tables):
    return evaluate.persistence(t.regional, "carbon_intensity", "settlement_period", ["region_id"])


def seasonal_naive(t: Tables):
    return evaluate.seasonal_naive(t.regional, "carbon_intensity", "settlement_period", ["region_id"])


def pinball(t: Tables):
    return _losses(t)


def pivot_alpha(t: Tables):
    return aggregates.pivot_values(_losses(t), "region_id", "alpha", ALPHA_COLUMNS, "pinball_loss")


def top_metrics(t: Tables):
    order = [F.col("pinball_loss").asc(), F.col("region_id").asc(), F.col("alpha").asc()]
    return aggregates.top_rows(_losses(t), order, 10)


def error_metrics(t: Tables):
    return evaluate.error_metrics(_scored(t), "carbon_intensity", "lag_1", ["region_id"])


def crossing(t: Tables):
    return evaluate.quantile_crossing(_scored(t), "lag_2", "lag_1", "lag_48", ["region_id"])


def calibration(t: Tables):
    banded = _scored(t).withColumns({"low": F.least("lag_1", "lag_48"), "high": F.greatest("lag_1", "lag_48")})
    return evaluate.calibration(banded, "carbon_intensity", "low", "high", ["region_id"])


def _short_region(t: Tables):
    """Region 3 once more, as region 103 with its periods of the first of January only."""
    first = t.regional.filter("region_id = 3 AND settlement_period < TIMESTAMP '2024-01-02'")
    return first.withColumn("region_id", F.col("region_id") + 100)


def folds(t: Tables):
    """Every region in five folds; a region of one day, too short for them, is reported as such."""
    rows = t.regional.unionByName(_short_region(t))
    found = evaluate.folds(rows, "settlement_period", ["region_id"], on_short="report")
    return found.groupBy("region_id", "fold", "role").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("settlement_period").alias("first_period"),
        F.max("settlement_period").alias("last_period"),
        F.sum("carbon_intensity").alias("carbon_sum"),
    )


def evaluation_table(t: Tables):
    """Out-of-fold stand-ins against both baselines, over every region."""
    df = add_windows(
        t.regional,
        "settlement_period",
        ["region_id"],
        lags={"p10": ("carbon_intensity", 2), "p50": ("carbon_intensity", 1), "persistence": ("carbon_intensity", 48),
              "seasonal_naive": ("carbon_intensity", 336)},
    )
    models = {"model_p10": ("p10", 0.1), "model_p50": ("p50", 0.5), "persistence": ("persistence", 0.5),
              "seasonal_naive": ("seasonal_naive", 0.5)}
    return evaluate.evaluation_table(df, "carbon_intensity", models)


def decision_quality(t: Tables):
    return evaluate.decision_quality(_scored(t), "carbon_intensity", "lag_1", ["region_id"])


def variant_compare(t: Tables):
    scored = _scored(t)
    variants = {
        n: evaluate.pinball_by_alpha(scored, "carbon_intensity", {c: 0.5}, ["region_id"])
        for n, c in {"no_weather": "lag_1", "with_weather": "lag_2"}.items()
    }
    return evaluate.compare_variants(variants)


def metrics_csv(t: Tables):
    """Loss rows of the real regions, written as CSV with a header and read back by schema."""
    losses = _losses(t).join(evaluate.error_metrics(_scored(t), "carbon_intensity", "lag_1", ["region_id"]), "region_id")
    path = work_path(t.spark, "metrics")
    name = F.concat(F.lit("Region "), F.col("region_id").cast("string")).alias("region")
    files.write_metrics(losses.select(name, "region_id", "alpha", "mae", "pinball_loss"), path)
    return files.read_metrics(t.spark, path).filter(F.col("region_id") <= 14)


def model_scope_compare(t: Tables):
    """Regional persistence against persistence of the national mean, on the same rows."""
    national = t.regional.groupBy("settlement_period").agg(F.avg("carbon_intensity").alias("national_mean"))
    national = add_windows(national, "settlement_period", lags={"national": ("national_mean", 48)})
    rows = persistence(t).withColumnRenamed("persistence", "regional")
    both = rows.join(national.select("settlement_period", "national"), "settlement_period").dropna(subset=["national"])
    models = {"national": ("national", 0.5), "regional": ("regional", 0.5)}
    return evaluate.evaluation_table(both, "carbon_intensity", models)


_TRAIN = "(SELECT * FROM gold WHERE lag_1 IS NOT NULL AND lag_2 IS NOT NULL AND lag_48 IS NOT NULL AND lag_336 IS NOT NULL)"


def _pin(p: str, a: str, y: str = "carbon_intensity") -> str:
    return f"avg(CASE WHEN {y} >= {p} THEN {a} * ({y} - {p}) ELSE ({a} - 1) * ({y} - {p}) END)"


_LOSSES = " UNION ALL ".join(
    f"SELECT region_id, {a}e0 AS alpha, {_pin(p, f'{a}e0')} AS pinball_loss FROM {_TRAIN} GROUP BY 1"
    for p, a in ALPHA_OF.items()
)
_LAG = "lag({c}, {n}) OVER (PARTITION BY region_id ORDER BY settlement_period) AS {name}"


def _baseline(name: str, n: int) -> str:
    return f"""SELECT region_id, settlement_period, carbon_intensity, {name} FROM (SELECT *,
        {_LAG.format(c='carbon_intensity', n=n, name=name)}, row_number() OVER (PARTITION BY region_id
        ORDER BY settlement_period) AS rn FROM regional) WHERE rn > {n}"""


def _evaluation(rows: str, y: str, models: dict[str, tuple[str, float]]) -> str:
    parts = []
    for m, (c, a) in models.items():
        mae = r(f"avg(abs({c} - {y}))", "mae") if a == 0.5 else "CAST(NULL AS DOUBLE) AS mae"
        rmse = r(f"sqrt(avg(({c} - {y}) * ({c} - {y})))", "rmse") if a == 0.5 else "CAST(NULL AS DOUBLE) AS rmse"
        parts.append(
            f"SELECT '{m}' AS model, {r(f'{a}e0', 'alpha')}, {r(_pin(c, f'{a}e0', y), 'pinball')}, {mae}, {rmse} FROM ({rows}) "
            f"WHERE {c} IS NOT NULL"
        )
    return " UNION ALL ".join(parts)


_WITH_SHORT = """SELECT region_id, settlement_period, carbon_intensity FROM regional UNION ALL SELECT region_id + 100,
    settlement_period, carbon_intensity FROM regional WHERE region_id = 3 AND settlement_period < TIMESTAMP '2024-01-02'"""
_FOLDS = " UNION ALL ".join(
    f"""SELECT *, {i} AS fold, CASE WHEN rn >= n - {5 - i} * size AND rn < n - {5 - i} * size + size THEN 'test'
    WHEN rn < n - {5 - i} * size - 48 THEN 'train' END AS role FROM numbered"""
    for i in range(5)
)

QUERIES = {
    "persistence": (persistence, sql("regional", _baseline("persistence", 48))),
    "seasonal_naive": (seasonal_naive, sql("regional", _baseline("seasonal_naive", 336))),
    "pinball": (
        pinball,
        sql("gold", f"SELECT region_id, {r('alpha', 'alpha')}, {r('pinball_loss', 'pinball_loss')} FROM ({_LOSSES})"),
    ),
    "pivot_alpha": (
        pivot_alpha,
        sql(
            "gold",
            "SELECT region_id, "
            + ", ".join(r(_pin(p, f"{a}e0"), f"alpha_{int(a * 100)}") for p, a in ALPHA_OF.items())
            + f" FROM {_TRAIN} GROUP BY 1",
        ),
    ),
    "top_metrics": (
        top_metrics,
        sql(
            "gold",
            f"""SELECT region_id, {r('alpha', 'alpha')}, {r('pinball_loss', 'pinball_loss')} FROM (SELECT * FROM ({_LOSSES})
            ORDER BY pinball_loss, region_id, alpha LIMIT 10)""",
        ),
    ),
    "error_metrics": (
        error_metrics,
        sql(
            "gold",
            f"""SELECT region_id, {r('avg(abs(lag_1 - carbon_intensity))', 'mae')},
            {r('avg((lag_1 - carbon_intensity) * (lag_1 - carbon_intensity))', 'mse')},
            {r('sqrt(avg((lag_1 - carbon_intensity) * (lag_1 - carbon_intensity)))', 'rmse')},
            {r('avg(abs(CAST(lag_1 - carbon_intensity AS DOUBLE) / nullif(carbon_intensity, 0)))', 'mape')}
            FROM {_TRAIN} GROUP BY 1""",
        ),
    ),
    "crossing": (
        crossing,
        sql(
            "gold",
            f"""SELECT region_id, CAST(sum(CASE WHEN lag_2 > lag_1 OR lag_1 > lag_48 THEN 1 ELSE 0 END) AS BIGINT)
            AS violation_count, {r('avg(CASE WHEN lag_2 > lag_1 OR lag_1 > lag_48 THEN 1 ELSE 0 END)', 'violation_pct')}
            FROM {_TRAIN} GROUP BY 1""",
        ),
    ),
    "calibration": (
        calibration,
        sql(
            "gold",
            f"""SELECT region_id, {r('100 * avg(CASE WHEN carbon_intensity BETWEEN least(lag_1, lag_48) AND '
            'greatest(lag_1, lag_48) THEN 1 ELSE 0 END)', 'inside_pct')} FROM {_TRAIN} GROUP BY 1""",
        ),
    ),
    "folds": (
        folds,
        sql(
            "regional",
            f"""SELECT region_id, fold, role, count(*) AS n_rows, min(settlement_period) AS first_period,
            max(settlement_period) AS last_period, CAST(sum(carbon_intensity) AS BIGINT) AS carbon_sum FROM (
            WITH numbered AS (SELECT *, n // 6 AS size FROM (SELECT *, row_number() OVER (PARTITION BY region_id
            ORDER BY settlement_period) - 1 AS rn, count(*) OVER (PARTITION BY region_id) AS n FROM ({_WITH_SHORT}))
            WHERE n // 6 >= 1 AND n - 48 - 5 * (n // 6) > 0) {_FOLDS}) WHERE role IS NOT NULL GROUP BY 1, 2, 3
            UNION ALL SELECT region_id, NULL, 'short', count(*), min(settlement_period), max(settlement_period),
            CAST(sum(carbon_intensity) AS BIGINT) FROM ({_WITH_SHORT}) GROUP BY 1
            HAVING NOT (count(*) // 6 >= 1 AND count(*) - 48 - 5 * (count(*) // 6) > 0)""",
        ),
    ),
    "evaluation_table": (
        evaluation_table,
        sql(
            "regional",
            _evaluation(
                "SELECT *, "
                + ", ".join(
                    _LAG.format(c="carbon_intensity", n=n, name=name)
                    for name, n in {"p10": 2, "p50": 1, "persistence": 48, "seasonal_naive": 336}.items()
                )
                + " FROM regional",
                "carbon_intensity",
                {"model_p10": ("p10", 0.1), "model_p50": ("p50", 0.5), "persistence": ("persistence", 0.5),
                 "seasonal_naive": ("seasonal_naive", 0.5)},
            ),
        ),
    ),
    "decision_quality": (
        decision_quality,
        sql(
            "gold",
            f"""SELECT region_id, {r('avg(abs(carbon_intensity - lag_1))', 'mae_gco2')},
            {r('100 * avg(CASE WHEN wrong THEN 1 ELSE 0 END)', 'decision_error_pct')},
            {r('coalesce(avg(CASE WHEN wrong THEN abs(carbon_intensity - t) END), 0)', 'carbon_penalty_gco2')},
            {r('max(t)', 'threshold_gco2')} FROM (SELECT *, (lag_1 < t) <> (carbon_intensity < t) AS wrong FROM {_TRAIN}
            JOIN (SELECT region_id, quantile_cont(carbon_intensity, 0.5) AS t FROM {_TRAIN} GROUP BY 1) USING (region_id))
            GROUP BY 1""",
        ),
    ),
    "variant_compare": (
        variant_compare,
        sql(
            "gold",
            f"""SELECT region_id, {r(_pin('lag_1', '0.5e0'), 'no_weather')}, {r(_pin('lag_2', '0.5e0'), 'with_weather')}
            FROM {_TRAIN} GROUP BY 1""",
        ),
    ),
    "metrics_csv": (
        metrics_csv,
        sql(
            "gold",
            f"""SELECT concat('Region ', region_id) AS region, region_id, {r('alpha', 'alpha')}, {r('mae', 'mae')},
            {r('pinball_loss', 'pinball_loss')} FROM ({_LOSSES}) JOIN (SELECT region_id, avg(abs(lag_1 - carbon_intensity))
            AS mae FROM {_TRAIN} GROUP BY 1) USING (region_id)""",
        ),
    ),
    "model_scope_compare": (
        model_scope_compare,
        sql(
            "regional",
            _evaluation(
                f"""SELECT b.carbon_intensity, b.regional, n.national FROM ({_baseline('regional', 48)}) b JOIN (
                SELECT settlement_period, lag(m, 48) OVER (ORDER BY settlement_period) AS national FROM (SELECT
                settlement_period, avg(carbon_intensity) AS m FROM regional GROUP BY 1)) n USING (settlement_period)
                WHERE n.national IS NOT NULL""",
                "carbon_intensity",
                {"national": ("national", 0.5), "regional": ("regional", 0.5)},
            ),
        ),
    ),
}
