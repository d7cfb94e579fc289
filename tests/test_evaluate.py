import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.helpers import period
from wattline.operators import aggregates as agg
from wattline.operators import evaluate as ev


def pairs(spark, rows):
    return spark.createDataFrame([(float(y), float(p)) for y, p in rows], "y double, p double")


def test_losses(spark):
    df = pairs(spark, [(10, 8), (10, 13), (0, 1)])
    m = ev.error_metrics(df, "y", "p").first()
    assert m["mae"] == 2.0 and m["mse"] == pytest.approx(14 / 3) and m["rmse"] == pytest.approx((14 / 3) ** 0.5)
    assert m["mape"] == pytest.approx(0.25)
    loss = ev.pinball_by_alpha(df, "y", {"p": 0.5}).first()["pinball_loss"]
    assert loss == pytest.approx(m["mae"] / 2)
    assert ev.pinball_by_alpha(df, "y", {"p": 0.9}).first()["pinball_loss"] == pytest.approx((0.9 * 2 + 0.1 * 3 + 0.1) / 3)


def test_crossing(spark):
    rows = [(2.0, 1.0, 3.0)] * 5 + [(1.0, 2.0, 3.0)] * 5
    got = ev.quantile_crossing(spark.createDataFrame(rows, "a double, b double, c double"), "a", "b", "c").first()
    assert (got["violation_count"], got["violation_pct"]) == (5, 0.5)


def test_baselines(spark):
    df = spark.createDataFrame([(period(i), 10 * (i + 1)) for i in range(4)], "t timestamp, y int")
    got = ev.persistence(df, "y", "t", h=1).orderBy("t").collect()
    assert [r["persistence"] for r in got] == [10, 20, 30] and [r["y"] for r in got] == [20, 30, 40]
    assert ev.seasonal_naive(df, "y", "t", season=3).first()["seasonal_naive"] == 10
    assert ev.seasonal_naive(df, "y", "t").count() == 0


def test_folds_follow_the_split_rule(spark):
    df = spark.createDataFrame([(period(i),) for i in range(1000)], "t timestamp")
    got = ev.folds(df, "t").toPandas()
    for i in range(5):
        train = got[(got.fold == i) & (got.role == "train")].row_no
        test = got[(got.fold == i) & (got.role == "test")].row_no
        start = 1000 - (5 - i) * 166
        assert (test.min(), test.max(), len(test)) == (start, start + 165, 166)
        assert (train.min(), train.max()) == (0, start - 49)
        assert test.min() - train.max() > 48
    with pytest.raises(Exception, match="too short"):
        ev.folds(df.limit(60), "t").collect()


def test_short_series_are_reported(spark):
    rows = [(k, period(i)) for k, n in ((1, 600), (2, 40)) for i in range(n)]
    df = spark.createDataFrame(rows, "k int, t timestamp")
    got = ev.folds(df, "t", ["k"], on_short="report").groupBy("k", "fold", "role").count().collect()
    assert [(r["fold"], r["role"], r["count"]) for r in got if r["k"] == 2] == [(None, "short", 40)]
    skipped = ev.folds(df, "t", ["k"], on_short="skip").groupBy("k", "fold", "role").count().collect()
    assert sorted(map(tuple, skipped)) == sorted(tuple(r) for r in got if r["k"] == 1)


@pytest.mark.parametrize("q, most_values", [(0.0, 20), (0.1, 9), (0.5, 20), (0.5, 1000000), (0.9, 300), (1.0, 20)])
def test_exact_percentile(spark, q, most_values):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"k": rng.choice([1, 1, 1, 2], 5000), "v": np.round(rng.lognormal(3, 2, 5000), 3)})
    pdf.loc[::50, "v"] = 1e9
    df = spark.createDataFrame(pdf)
    got = {r["k"]: r["p"] for r in agg.exact_percentile(df, "v", q, ["k"], "p", most_values).collect()}
    for k, g in pdf.groupby("k"):
        assert got[k] == pytest.approx(np.quantile(g["v"], q), rel=1e-9)
    whole = agg.exact_percentile(df, "v", q, name="p", most_values=most_values).first()["p"]
    assert whole == pytest.approx(np.quantile(pdf["v"], q), rel=1e-9)


def test_decision_quality(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 9), ("a", 3, 3), ("a", 10, 1), ("b", 5, 5)], "k string, y int, p int")
    got = {r["k"]: r for r in ev.decision_quality(df, "y", "p", ["k"]).collect()}
    assert got["a"]["threshold_gco2"] == 2.5
    assert got["a"]["decision_error_pct"] == 50.0 and got["a"]["carbon_penalty_gco2"] == pytest.approx((0.5 + 7.5) / 2)
    assert got["b"]["carbon_penalty_gco2"] == 0.0


def test_evaluation_table_and_variants(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (3.0, 2.0, 3.0)], "y double, m double, b double")
    got = {r["model"]: r for r in ev.evaluation_table(df, "y", {"m10": ("m", 0.1), "b": ("b", 0.5)}).collect()}
    assert got["m10"]["mae"] is None and got["b"]["mae"] == 0.0 and got["m10"]["pinball"] == pytest.approx(0.5)
    a = spark.createDataFrame([(1, 0.5, 3.0), (1, 0.9, 9.0)], "region_id int, alpha double, pinball_loss double")
    b = spark.createDataFrame([(1, 0.5, 2.0)], "region_id int, alpha double, pinball_loss double")
    assert ev.compare_variants({"plain": a, "weather": b}).first().asDict() == {"region_id": 1, "plain": 3.0, "weather": 2.0}


def test_profile_and_pivot(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None), (3, 4.0)], "a int, b double")
    got = {r["column_name"]: r for r in agg.profile(df).collect()}
    assert (got["b"]["n"], got["b"]["mean"], got["a"]["max"]) == (2, 3.0, 3.0)
    wide = agg.pivot_values(df, "a", "b", {"two": 2.0, "four": 4.0}, "b").orderBy("a").collect()
    assert wide[0]["two"] == 2.0 and wide[0]["four"] is None
    assert [r["a"] for r in agg.top_rows(df, [F.desc("a")], 2).collect()] == [3, 2]
